"""Secret scan with multipart credential linking, in DataFrame expressions only.

Base spans per kind, leftmost and non-overlapping: ``assign`` (a named value of 8 or more characters),
``access`` (an access identifier of 16 or more), ``hex`` (a run of 32 or more). They are always reported.
Two weaker kinds are reported only where complementary parts meet within ``scope`` code points of the
same document:

* ``key``: a base64-like run of 20 or more characters that mixes lower case, upper case and digits, when
  an access identifier lies in scope; runs that overlap a base span are not candidates;
* ``endpoint``: a URL or a dotted host name with a port, when an access identifier and a secret (assign,
  hex or reported key) both lie in scope.

The link is an interval join on (document, bin of ``scope`` code points). Anchors are first reduced to
the outermost two of those that start in one bin, which decide every distance test exactly: as they start
within ``scope``, a part between the two is in scope of one. They are listed in every bin from ``scope`` before their first start to
``scope`` behind their last end, and a part is looked up in every bin it touches, so a pair in scope
has a bin in common however long either is. No pairs are formed, and as spans of a kind do not overlap,
a document costs in proportion to its parts and its length.

Offsets are code points, the end exclusive. Defined results: a null text is empty; an empty text has
no span and the digest of the empty string. Rows that repeat a ``doc_id`` and text get the same result
each. A null ``doc_id`` is an id of its own. Other columns are ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import stage, table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KEY = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# A host begins where a run of labels begins (or where the match before ended) and never gives a label back, so that a
# text of any length is read once, without a deep stack.
ENDPOINT = (
    r"""https?://[A-Za-z0-9.-]+(?::[0-9]+)?[^\s"'<>]*"""
    r"""|(?:\G|(?<![A-Za-z0-9-])(?<![A-Za-z0-9-]\.))(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}:[0-9]{2,5}"""
)
KINDS = ["assign", "access", "hex", "key", "endpoint"]
SCOPE = 400
BLOCK = 64


def _running(lengths: Column) -> Column:
    """Sums of all elements before each element, in blocks so that long arrays stay cheap."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(lengths) / BLOCK).cast("int") - 1)),
        lambda b: total(F.slice(lengths, b * BLOCK + 1, BLOCK)),
    )
    starts = F.transform(blocks, lambda _, b: total(F.slice(blocks, F.lit(1), b)))
    return F.flatten(F.transform(starts, lambda base, b: _within(F.slice(lengths, b * BLOCK + 1, BLOCK), base)))


def _within(block: Column, base: Column) -> Column:
    return F.transform(block, lambda _, i: base + F.aggregate(F.slice(block, F.lit(1), i), F.lit(0), lambda a, x: a + x))


def spans(text: Column, pattern: str, kind: int, group_min: int | None = None) -> Column:
    """All matches of ``pattern`` as structs (start, end, kind, text), in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.zip_with(gaps, found, lambda gap, hit: F.length(gap) + F.length(hit))
    before = _running(steps)
    rows = F.zip_with(
        F.zip_with(before, gaps, lambda at, gap: at + F.length(gap)), found,
        lambda at, hit: F.struct(at.alias("start"), (at + F.length(hit)).alias("end"), F.lit(kind).alias("kind"), hit.alias("hit")),
    )
    if group_min is not None:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        long_enough = F.transform(values, lambda v: F.length(v) >= group_min)
        rows = F.transform(
            F.filter(F.arrays_zip(rows.alias("s"), long_enough.alias("ok")), lambda x: x["ok"]), lambda x: x["s"]
        )
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:int,hit:string>>)")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def _places(hits: Column) -> Column:
    return F.transform(hits, lambda s: F.struct(s["start"], s["end"], s["kind"]))


def _mixed(hit: Column) -> Column:
    return hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9]")


def _written(found: Column) -> Column:
    """Spans as text, by start, then kind as listed."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def _in_scope(parts: DataFrame, anchors: DataFrame, scope: int, name: str) -> DataFrame:
    """Keys and places of ``parts`` that have an anchor at most ``scope`` code points away."""
    bins = lambda low, high: F.explode(F.expr(f"sequence(({low}) div {scope}, ({high}) div {scope})"))
    outer = anchors.groupBy("doc_id", "text_key", F.expr(f"start div {scope}").alias("bin")).agg(
        F.min("start").alias("first"), F.max("end").alias("last")
    )
    near = outer.select(
        F.col("doc_id").alias("a_id"), F.col("text_key").alias("a_key"), "first", "last",
        bins(f"first - {scope}", f"last + {scope}").alias("a_bin"),
    )
    probe = parts.withColumn("bin", bins("start", "end"))
    joined = probe.join(
        near,
        probe["doc_id"].eqNullSafe(near["a_id"]) & (probe["text_key"] == near["a_key"]) & (probe["bin"] == near["a_bin"])
        & (F.col("first") <= F.col("end") + scope) & (F.col("last") >= F.col("start") - scope),
        "left_semi",
    )
    return joined.select("doc_id", "text_key", "start", "end", "kind").distinct().withColumn("why", F.lit(name))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, base and linked spans as arrays of (start, end, kind)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    found = rows.select(
        "doc_id", F.xxhash64("text", F.length("text")).alias("text_key"),
        _places(spans(text, ASSIGN, 0, group_min=8)).alias("assign"),
        _places(spans(text, ACCESS, 1)).alias("access"),
        _places(spans(text, HEX, 2)).alias("hex"),
        _places(F.filter(spans(text, KEY, 3), lambda s: _mixed(s["hit"]))).alias("key"),
        _places(spans(text, ENDPOINT, 4)).alias("endpoint"),
    )
    found = stage(found.withColumn("base", F.concat("assign", "access", "hex")).drop("assign", "access", "hex"), "secret-parts")

    def parts(column: str, where: str = "true") -> DataFrame:
        return (
            found.where((F.size("base") > 0) & (F.size(column) > 0))
            .select("doc_id", "text_key", F.explode(column).alias("s")).select("doc_id", "text_key", "s.*").where(where).distinct()
        )

    access = parts("base", "kind = 1")
    free_keys = found.where((F.size("base") > 0) & (F.size("key") > 0)).select(
        "doc_id", "text_key",
        F.explode(F.filter("key", lambda k: ~F.exists("base", lambda b: (b["start"] < k["end"]) & (k["start"] < b["end"])))).alias("s"),
    ).select("doc_id", "text_key", "s.*").distinct()
    keys = _in_scope(free_keys, access, scope, "access")
    place = ["doc_id", "text_key", "start", "end", "kind"]
    secrets = parts("base", "kind <> 1").select(place).unionByName(keys.select(place))
    endpoints = _in_scope(_in_scope(parts("endpoint"), access, scope, "access"), secrets, scope, "secret")
    linked = (
        keys.select(place).unionByName(endpoints.select(place)).groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "end", "kind")).alias("linked"))
        .select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key"), "linked")
    )
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:int>>)")
    held = found.where(F.size("base") > 0).select("doc_id", "text_key", "base").join(
        linked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("text_key") == F.col("l_key")), "left"
    ).select("doc_id", "base", F.coalesce("linked", none).alias("linked"))
    return held.unionByName(found.where(F.size("base") == 0).select("doc_id", "base", none.alias("linked")))


def query(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "linked")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
