"""Secret scans with corpus-wide ownership: DataFrame functions only.

Base spans are the matches of PATTERNS, leftmost and non-overlapping per kind, without those whose value is too short. Bare
runs of key-like characters that mix letters and digits are candidates as well. The hash of every candidate value, base or
bare, is counted over the corpus by distinct owner and repository. A value of at most MAX_OWNERS owners and MAX_REPOSITORIES
repositories is live: it belongs to somebody. A value that more of them have is an example that was copied around.
A bare run that is live becomes a span of kind "owned", unless a base span overlaps it; base spans stay whatever their verdict.

The patterns run once over the texts; rows with candidates (no text, only its digest and spans) are written to the shared folder.
Values are counted once per (value, repository) before they meet, so that a value of a third of all rows is a few rows; spans
depend on the text alone, so that verdicts are kept once per distinct text and joined back on its digest: broadcast if their
measured size allows, else by a salted shuffle, so that copies of one text spread over SALTS tasks.

Null and empty texts have no spans. A null owner or repository counts as one of its own. Repeated rows get the same spans
each. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.storage import checkpointed, under_plain_names

MAX_OWNERS = 2
MAX_REPOSITORIES = 4
#: kind: pattern, group of the value, least characters of the value
PATTERNS = {
    "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),  # shorter runs are dropped anyway, and a run cannot begin inside another
}
#: Bare candidates: possessive, as what follows a run of these characters is never one of them.
BARE = (r"[A-Za-z0-9+/_-]{20,}+={0,2}", 0, 20)
KINDS = [*PATTERNS, "owned"]
REPLACEMENT = "[SECRET]"
SPANS = "array<struct<start:bigint,kind:int,end:bigint,live:boolean>>"
#: Verdicts are broadcast up to this size; a text counts as TEXT_BYTES and SPAN_BYTES for each span.
BROADCAST_BYTES = 32 << 20
TEXT_BYTES, SPAN_BYTES = 200, 64
SALTS = 16


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often lambdas inside refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def numbers(n: Column) -> Column:
    return F.sequence(F.lit(1), n)


def running(sizes: Column) -> Column:
    """Sums of the values before each of a filled array, by blocks: long arrays take no quadratic time."""
    block = 256
    zero = F.lit(0).cast("long")
    sums = lambda values: F.aggregate(values, F.array(zero), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    part = lambda k: F.slice(sizes, (k - 1) * block + 1, F.lit(block))
    parts = numbers(F.ceil(F.size(sizes) / block).cast("int"))
    bases = sums(F.transform(parts, lambda k: F.aggregate(part(k), zero, lambda a, x: a + x)))
    return let(bases, lambda b: F.flatten(F.transform(parts, lambda k: F.transform(F.slice(sums(part(k)), 1, F.size(part(k))), lambda x: x + F.element_at(b, k)))))


def located(text: Column, matches: Column, values: Column, pattern: str, kind: str, least: int) -> Column:
    """Spans of the matches with a value of enough characters; what stands between two matches says where they are."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    parts = F.struct(gaps.alias("gaps"), F.transform(matches, lambda m: F.length(m).cast("long")).alias("sizes"), values.alias("values"))

    def spans(p: Column) -> Column:
        steps = F.transform(numbers(F.size(p["sizes"])), lambda i: F.element_at(p["gaps"], i) + F.element_at(p["sizes"], i))
        span = lambda before: lambda i: F.struct(
            (F.element_at(before, i) + F.element_at(p["gaps"], i)).alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            (F.element_at(before, i) + F.element_at(p["gaps"], i) + F.element_at(p["sizes"], i)).alias("end"),
            F.element_at(p["values"], i).alias("value"),
        )
        return let(let(steps, running), lambda before: F.transform(numbers(F.size(p["sizes"])), span(before)))

    found = F.filter(let(parts, spans), lambda s: F.length(s["value"]) >= least)
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>"))


def with_spans(docs: DataFrame, text: str) -> DataFrame:
    """The rows with __base and __bare: arrays of spans (start, kind, end, value) in order; __key: digest of a text that has any."""
    source = F.coalesce(docs[text], F.lit(""))
    found = {}
    for kind, (pattern, _, _) in {**PATTERNS, "owned": BARE}.items():
        found[f"__{kind}"] = F.regexp_extract_all(source, F.lit(pattern), F.lit(0))
    rows = docs.withColumns(found)
    # a match alone matches as it did in its text: what follows it is no character of a value
    values = {f"__{kind}_value": F.transform(f"__{kind}", lambda m: F.regexp_extract(m, pattern, group)) if group else F.col(f"__{kind}") for kind, (pattern, group, _) in {**PATTERNS, "owned": BARE}.items()}
    rows = rows.withColumns(values)
    spans = {f"__spans_{kind}": located(F.coalesce(F.col(text), F.lit("")), F.col(f"__{kind}"), F.col(f"__{kind}_value"), pattern, kind, least) for kind, (pattern, _, least) in {**PATTERNS, "owned": BARE}.items()}
    rows = rows.withColumns(spans).drop(*found, *values)
    base = F.array_sort(F.concat(*(F.col(f"__spans_{kind}") for kind in PATTERNS)))
    # key-like: letters and digits, and many different characters
    like = lambda v: v.rlike("[0-9].*[0-9].*[0-9]") & v.rlike("[A-Za-z].*[A-Za-z].*[A-Za-z]") & (F.size(F.array_distinct(F.split(v, ""))) >= 10)
    rows = rows.withColumns({"__base": base, "__likely": F.filter("__spans_owned", lambda s: like(s["value"]))}).drop(*spans)
    free = F.filter("__likely", lambda s: ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    rows = rows.withColumn("__bare", F.when(F.size("__likely") > 0, free).otherwise(F.col("__likely"))).drop("__likely")
    return rows.withColumn("__key", F.when((F.size("__base") > 0) | (F.size("__bare") > 0), F.sha2(F.col(text), 256)))


def candidates(docs: DataFrame, owner: str, repository: str, text: str) -> DataFrame:
    """Of each row with candidates: key (digest of its text), owner, repository, base and bare spans."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = docs.select(name(owner).alias("owner"), name(repository).alias("repository"), F.col(text).alias("text"))
    rows = with_spans(named, "text").where("__key is not null")
    return rows.select(F.col("__key").alias("key"), "owner", "repository", F.col("__base").alias("base"), F.col("__bare").alias("bare"))


def hashes(spans: Column) -> Column:
    return F.array_distinct(F.transform(spans, lambda s: F.sha2(s["value"], 256)))


def ownership(rows: DataFrame) -> DataFrame:
    """Of each candidate's hash: n_owners, n_repositories. A repository belongs to an owner. rows: of candidates."""
    once = rows.select(F.explode(hashes(F.concat("base", "bare"))).alias("hash"), "owner", "repository").distinct()
    by_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def verdicts(rows: DataFrame) -> DataFrame:
    """Of each distinct text with candidates (key): found, a struct of base and all spans. rows: of candidates."""
    live = ownership(rows).where((F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repositories") <= MAX_REPOSITORIES)).select("hash")
    texts = rows.select("key", "base", "bare").dropDuplicates(["key"])
    values = texts.select("key", F.explode(hashes(F.concat("base", "bare"))).alias("hash"))
    of_text = values.join(live, "hash").groupBy("key").agg(F.collect_set("hash").alias("live"))  # at most the values of one text
    is_live = lambda s: F.coalesce(F.array_contains("live", F.sha2(s["value"], 256)), F.lit(False))
    told = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), is_live(s).alias("live"))
    judged = texts.join(of_text, "key", "left").select("key", F.transform("base", told).alias("base"), F.filter(F.transform("bare", told), lambda s: s["live"]).alias("owned"))
    return judged.select("key", F.struct("base", F.array_sort(F.concat("base", "owned")).alias("spans")).alias("found"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "lang", text: str = "text", into: str = "secrets") -> DataFrame:
    """The rows with a struct column into (replaced if there is one): base and spans, arrays of (kind, start, end, live).

    repository names a column that tells the repositories of an owner apart."""
    return under_plain_names(docs, [owner, repository, text], scanned, into)


def scanned(docs: DataFrame, owner: str, repository: str, text: str) -> DataFrame:
    """The rows with the column found."""
    rows = checkpointed(candidates(docs, owner, repository, text))
    judged = verdicts(rows).withColumnsRenamed({"key": "__text", "found": "__found"})
    sizes = rows.dropDuplicates(["key"]).select((F.lit(TEXT_BYTES) + SPAN_BYTES * (F.size("base") + F.size("bare"))).cast("long").alias("bytes"))
    n_bytes = sizes.agg(F.sum("bytes")).first()[0] or 0
    keyed = docs.withColumn("__key", F.sha2(F.col(text), 256))
    if n_bytes <= BROADCAST_BYTES:
        joined = keyed.join(F.broadcast(judged), keyed["__key"] == judged["__text"], "left")
    else:
        hashed = [c.name for c in docs.schema if "map<" not in c.dataType.simpleString()]
        keyed = keyed.withColumn("__salt", F.pmod(F.xxhash64(*hashed), F.lit(SALTS)).cast("int"))
        judged = judged.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.join(judged, (keyed["__key"] == judged["__text"]) & (keyed["__salt"] == judged["__copy"]), "left")
    spans = lambda name: F.coalesce(F.col(f"__found.{name}"), F.array().cast(SPANS)).alias(name)
    return joined.select(*docs.columns, F.struct(spans("base"), spans("spans")).alias("found"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, owner: str = "source", repository: str = "lang", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The rows with every live span of the text replaced; values that many owners have are left. n_chars is counted anew."""
    plain = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    new = redacted(docs.toDF(*plain.values()), plain[owner], plain[repository], plain[text], plain.get(n_chars))
    return new.toDF(*docs.columns)


def redacted(docs: DataFrame, owner: str, repository: str, text: str, n_chars: str | None) -> DataFrame:
    into = "found"
    rows = scanned(docs, owner, repository, text)
    live = F.filter(F.col(into)["spans"], lambda s: s["live"])
    rows = rows.withColumn(into, live)
    # spans of different kinds may overlap: what is left stands between the furthest end so far and the next start
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["parts"]).otherwise(F.concat(a["parts"], F.array(F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))))).alias("parts"),
    )
    whole = lambda a: F.array_join(F.concat(a["parts"], F.array(F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))), REPLACEMENT)
    rows = rows.withColumn("__new", F.when(F.size(into) > 0, F.aggregate(F.col(into), start, step, whole)).otherwise(F.col(text)))
    changes = {text: F.col("__new")}
    if n_chars and n_chars in docs.columns:
        changes[n_chars] = F.when(F.size(into) > 0, F.length("__new").cast(docs.schema[n_chars].dataType)).otherwise(F.col(n_chars))
    return rows.withColumns(changes).select(*docs.columns)
