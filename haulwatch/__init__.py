"""haulwatch: PySpark analytics over GPS positions of haulage vehicles."""

__version__ = "0.1.0"
