"""MinHash near-dedup by an inverted join on signature coordinates.

A document is the set of its distinct three-word shingles; equal sets form a class, and only classes are
compared. A class has ``COORDINATES`` MinHash values; each (coordinate, value) pair is a token.

1. *Prefix*: two classes that agree in at least ``MATCHES`` coordinates share one of the first
   ``COORDINATES - MATCHES + 1`` tokens of either, in a common order from rare to frequent. Only these are
   posted, and of these only tokens that occur twice, so most documents post nothing, and the common
   values of boilerplate are rarely reached.
2. *Skip*: postings carry four bits of every coordinate. The join compares them in one expression and
   drops a pair that can not reach ``MATCHES`` before it becomes a row.
3. Every list first links its members to its most common one, the member with the fewest tokens of its own,
   which in a group of near copies is the text they were made from. Confirmed links give first components.
   A list whose members are then all connected needs nothing more: a list of very many near copies
   costs its length, not its square.
4. Members of the lists that stay mixed are joined on the shingles themselves, exactly: shingles in an order
   from rare to frequent, a prefix of 15 % of each set, of which shingles that occur once are left out,
   and two bounds inside the join. One comes from sizes and positions. The other from parity bitmaps: a set's
   hashes set and clear bits in turn, so the bits in which two bitmaps differ never outnumber the shingles
   of one set only. A pair that fails either is no row. Lists are joined by size class as well, a bitmap of
   two to four bits a shingle (``PARITY_WORDS`` longs at most) for each class a partner may have.
   First, in up to ``ROUNDS`` rounds, members meet two heads of each list only, and components that links
   join become one; where most members are linked to many, few are left outside.
   Only members outside a list's largest component are then joined to all members of other components.
5. Every link is confirmed on the full shingle sets: 100 * intersection >= 85 * union.

At a similarity of 0.85 two signatures agree in 27 of 32 coordinates on average; fewer than 16 agree with
a probability of 5.7e-7 (3.3e-5 at 0.8): such a link is lost unless other documents connect the two.

Shingles are compared by 64-bit hashes, sets by two 64-bit sums and their size; these three are the class's
name up to the end, where each component takes the smallest id of its rows. Defined results: null texts
and texts without words have the empty set, are linked to nothing and stay. Texts of one or two words are one
shingle. Every row is judged on its own text, so rows without an id and rows that share one are linked like
any other; a component that has no id at all has a null one. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import wordhash as wh
from skyledger.llm.components import components
from skyledger.llm.tables import key_filter, map_arrow, stage, table, with_filter

COORDINATES = 32
MATCHES = 16
WORDS = 3
SET_BATCH = 1 << 17  # shingles in an Arrow batch of sets, but for the last set
PARITY_WORDS = 64  # longs in the largest parity bitmap; beyond some 2,000 shingles it spares less, and loses nothing
ROUNDS = 4  # of heads at most, and no further one after a round that joined less than a part in ROUND_SHARE to another
ROUND_SHARE = 64
_RNG = np.random.default_rng(20)
_ODD = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_NIBBLES = 0x1111111111111111


def _sets(texts: pa.Array, words: int):
    """(row, sorted distinct shingle hashes) of every row."""
    for first, last, data, offsets in wh.text_slices(texts):
        _, _, hashes, bounds = wh.words(data, offsets, lower=True)
        values, _, cuts = wh.shingles(hashes, bounds, words)
        for k in range(last - first):
            yield first + k, np.unique(values[cuts[k] : cuts[k + 1]])


def _signature(values: np.ndarray) -> np.ndarray:
    low = np.array([((values ^ add) * odd).min() for odd, add in zip(_ODD, _ADD, strict=True)], np.uint64)
    return (low >> np.uint64(32)).astype(np.int64) | (np.arange(COORDINATES, dtype=np.int64) << 32)


def _name(values: np.ndarray) -> bytes:
    """Name of a set: its size and two sums."""
    sums = [wh.mix(values).sum(dtype=np.uint64), wh.mix(values + np.uint64(77)).sum(dtype=np.uint64)]
    return np.array([len(values), *sums], ">u8").tobytes()


def sketch(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, hash of the text, n_shingles, name of the set (null if empty) and its signature tokens."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("id", T.BinaryType()), T.StructField("tokens", T.ArrayType(T.LongType())),
    ])

    def describe(batches):
        for batch in batches:
            sizes, names, tokens = [], [], []
            for _, values in _sets(batch.column(1), words):
                sizes.append(len(values))
                names.append(_name(values) if len(values) else None)
                tokens.append(_signature(values) if len(values) else np.zeros(0, np.int64))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                ],
                names=schema.names,
            )

    return map_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), describe, schema)


def _nibbles(part: Column) -> Column:
    """Sixteen tokens' lowest four bits in one long."""
    return F.aggregate(part, F.lit(0).cast("long"), lambda a, t: F.shiftleft(a, 4).bitwiseOR(t.bitwiseAND(F.lit(15))))


def _unequal(left: str, right: str) -> Column:
    x = F.col(left).bitwiseXOR(F.col(right))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    return F.bit_count(x.bitwiseAND(F.lit(_NIBBLES)))


def _alike() -> Column:
    return _unequal("s1", "t1") + _unequal("s2", "t2") <= COORDINATES - MATCHES


def post(classes: DataFrame) -> DataFrame:
    """Postings (token, id, s1, s2) of the prefix tokens that occur more than once."""
    half = COORDINATES // 2
    exploded = classes.select("id", F.explode("tokens").alias("token"))
    repeated = stage(exploded.groupBy("token").agg(F.count("*").alias("frequency")).where("frequency > 1"), "near-tokens")
    possible = with_filter(exploded, [F.col("token")], key_filter(repeated, ["token"]), "maybe").where("maybe").drop("maybe")
    shared = possible.join(repeated.withColumnRenamed("token", "r_token"), F.col("token") == F.col("r_token"))
    ordered = shared.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("frequency", "token"))).alias("tokens"))
    # The tokens that occur once come first in the order; what the prefix has left goes to the others.
    left = F.size("tokens") - (MATCHES - 1)
    prefix = ordered.where(left > 0).select(F.col("id").alias("p_id"), F.size("tokens").alias("common"), F.slice("tokens", F.lit(1), left).alias("prefix"))
    bits = classes.select(
        "id", _nibbles(F.slice("tokens", 1, half)).alias("s1"), _nibbles(F.slice("tokens", half + 1, half)).alias("s2")
    )
    return bits.join(prefix, F.col("id") == F.col("p_id")).select(
        F.explode("prefix.token").alias("token"), "id", "s1", "s2", "common"
    )


def _size_class(n: int) -> int:
    return n.bit_length() - 1


def _parity(values: np.ndarray, size_class: int) -> np.ndarray:
    """Bitmap of the sets of a size class: each hash turns one bit over."""
    width = min(max(1 << max(size_class - 4, 0), 4), PARITY_WORDS)
    odd = np.bincount((wh.mix(values) & np.uint64(64 * width - 1)).astype(np.int64), minlength=64 * width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _partner_classes(n: int, numerator: int, denominator: int) -> range:
    """Size classes of the sets that may be similar enough to one of ``n`` shingles."""
    return range(_size_class(max(1, -(-n * numerator // denominator))), _size_class(n * denominator // numerator) + 1)


def full_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, words: int, numerator: int = 1, denominator: int = 1) -> DataFrame:
    """(id, shingles, low, parities) of the classes in ``ids``, one row each, from the rows ``classes`` takes them from.

    ``parities`` holds the bitmaps for the size classes of similar sets, from the class ``low`` on.
    """
    place = ["doc_id", "text_hash"]
    asked = stage(classes.join(ids.distinct(), "id", "left_semi").select("id", *place, "copies"), "near-asked")
    rows = with_filter(docs.withColumn("text_hash", F.xxhash64("text")), [F.col(c) for c in place], key_filter(asked, place), "maybe").where("maybe")
    # Rows equal in id and text can't be told apart. They are few, or combined before their shuffle.
    several = asked.where("copies > 1")
    rows = with_filter(rows.drop("maybe"), [F.col(c) for c in place], key_filter(several, place), "repeated").select(*place, "text", "repeated")
    wanted = rows.where("not repeated").drop("repeated").unionAll(rows.where("repeated").drop("repeated").distinct())

    def collect(batches):
        for batch in batches:
            rows, sets, held = [], [], 0
            for row, values in _sets(batch.column(2), words):
                rows.append(row)
                sets.append(values.view(np.int64))
                held += len(values)
                if held >= SET_BATCH:
                    yield _held(batch, rows, sets, numerator, denominator)
                    rows, sets, held = [], [], 0
            yield _held(batch, rows, sets, numerator, denominator)

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("id", T.BinaryType()),
        T.StructField("shingles", longs), T.StructField("low", T.IntegerType()), T.StructField("parities", T.ArrayType(longs)),
    ])
    exact = asked.select(*[F.col(c).alias(f"a_{c}") for c in ("id", *place)])
    same = (F.col("id") == F.col("a_id")) & (F.col("text_hash") == F.col("a_text_hash")) & F.col("doc_id").eqNullSafe(F.col("a_doc_id"))
    return stage(map_arrow(wanted, collect, schema).join(exact, same, "left_semi").drop(*place), "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    side = lambda name: sets.select(F.col("id").alias(f"{name}_id"), F.col("shingles").alias(f"{name}_set"))
    both = pairs.join(side("a"), F.col("a") == F.col("a_id")).join(side("b"), F.col("b") == F.col("b_id"))
    # In the JVM row by row: an Arrow batch of pairs would hold two full sets for each of its rows.
    common = F.size(F.array_intersect("a_set", "b_set")).cast("long")
    similar = denominator * common >= numerator * (F.size("a_set") + F.size("b_set") - common)
    return stage(both.where(similar).select("a", "b"), "near-links")


def shingle_postings(sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Postings (token, id, n, at) of the shingles in each set's prefix that occur more than once.

    The order is from rare to frequent, so shingles that occur once come first; ``at`` counts them.
    """
    sets = sets.select("id", F.size("shingles").alias("n"), "shingles")
    exploded = sets.select("id", "n", F.explode("shingles").alias("token"))
    repeated = stage(exploded.groupBy("token").agg(F.count("*").alias("frequency")).where("frequency > 1"), "near-shingles")
    possible = with_filter(exploded, [F.col("token")], key_filter(repeated, ["token"]), "maybe").where("maybe").drop("maybe")
    shared = possible.join(repeated.withColumnRenamed("token", "r_token"), F.col("token") == F.col("r_token"))
    ordered = shared.groupBy("id", "n").agg(F.array_sort(F.collect_set(F.struct("frequency", "token"))).alias("tokens"))
    alone = F.col("n") - F.size("tokens")
    prefix = F.col("n") - F.ceil(F.col("n") * numerator / denominator).cast("int") + 1
    held = ordered.withColumns({"alone": alone, "left": prefix - alone}).where(F.col("left") > 0)
    return held.select("id", "n", "alone", F.posexplode(F.slice("tokens", F.lit(1), F.col("left"))).alias("step", "t")).select(
        F.col("t.token").alias("token"), "id", "n", (F.col("alone") + F.col("step")).alias("at")
    )


def _size_bits(n: str) -> Column:
    return F.length(F.bin(F.col(n))) - 1


def _possible(numerator: int, denominator: int, o_bits: Column | str = "o_bits") -> Column:
    """Whether sizes and positions, then the parity bitmaps, leave room for enough common shingles."""
    both = F.col("n") + F.col("o_n")
    room = F.least(F.col("n") - F.col("at"), F.col("o_n") - F.col("o_at")) * (numerator + denominator) >= numerator * both
    differ = F.aggregate(F.zip_with("bits", o_bits, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    return room & (differ * (numerator + denominator) <= (denominator - numerator) * both)


def _mixed(posted: DataFrame) -> DataFrame:
    """Postings (token, id, n, at, part) of the lists that hold several parts, with the ``largest`` of these."""
    mixed = stage(
        posted.groupBy("token", "part").agg(F.count("*").alias("size"))
        .groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("size", "part"))["part"].alias("largest"))
        .where("parts > 1").select(F.col("token").alias("m_token"), "largest"),
        "near-mixed",
    )
    return stage(posted.join(mixed, F.col("token") == F.col("m_token")).drop("m_token"), "near-open")


def _ordered(joined: DataFrame) -> DataFrame:
    return stage(joined.select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b")).distinct(), "near-pairs")


def to_heads(held: DataFrame, members: DataFrame, number: int, numerator: int, denominator: int) -> DataFrame:
    """Pairs that may be similar enough, of each list's members and two heads of it: one in its largest part, one outside.

    The heads come first in an order of the list and the round, so lists of the same members have different heads.
    """
    row = F.struct(F.xxhash64("token", "id", F.lit(number)).alias("rank"), "id", "n", "at", "part")
    parities = members.select(F.col("id").alias("m_id"), "low", "parities")
    heads = (
        held.groupBy("token", (F.col("part") == F.col("largest")).alias("main")).agg(F.min(row).alias("h"))
        .select(F.col("token").alias("o_token"), *[F.col(f"h.{c}").alias(f"o_{c}") for c in ("id", "n", "at", "part")])
        .join(parities, F.col("o_id") == F.col("m_id")).drop("m_id").withColumnsRenamed({"low": "o_low", "parities": "o_parities"})
    )
    bits = held.join(parities, F.col("id") == F.col("m_id")).select(
        "token", "id", "n", "at", "part", F.get("parities", _size_bits("n") - F.col("low")).alias("bits")
    )
    # The head's bitmap for the other's size class; it has none where their sizes differ too much.
    o_bits = F.get("o_parities", _size_bits("n") - F.col("o_low"))
    return _ordered(bits.join(
        heads, (F.col("token") == F.col("o_token")) & (F.col("part") != F.col("o_part")) & _possible(numerator, denominator, o_bits)
    ))


def across(held: DataFrame, members: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs of different parts that may be similar enough.

    From postings (token, id, n, at, part, largest) of mixed lists and members (id, low, parities).
    """
    held = held.join(members.select(F.col("id").alias("m_id"), "low", "parities"), F.col("id") == F.col("m_id")).drop("m_id")
    size_class = _size_bits("n")
    any_ = held.withColumns({"class": size_class, "bits": F.get("parities", size_class - F.col("low"))}).drop("low", "parities")
    other = (
        held.where(F.col("part") != F.col("largest")).select("*", F.posexplode("parities").alias("step", "o_bits"))
        .select(*[F.col(c).alias(f"o_{c}") for c in ("token", "id", "n", "at", "part")], (F.col("low") + F.col("step")).alias("o_class"), "o_bits")
    )
    return _ordered(any_.join(
        other,
        (F.col("token") == F.col("o_token")) & (F.col("class") == F.col("o_class")) & (F.col("part") != F.col("o_part"))
        & ((F.col("part") == F.col("largest")) | (F.col("id") < F.col("o_id"))) & _possible(numerator, denominator),
    ))


def links_across(sets: DataFrame, members: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Links that connect the parts of ``members`` (id, part, low, parities) as all links between them would."""
    parts = members.select("id", "part")
    posted = shingle_postings(sets, numerator, denominator)
    held = _mixed(stage(posted.join(parts.withColumnRenamed("id", "m_id"), F.col("id") == F.col("m_id")).drop("m_id"), "near-shingle-postings"))
    links = None
    for number in range(ROUNDS):
        found = confirmed(to_heads(held, members, number, numerator, denominator), sets, numerator, denominator)
        links = found if links is None else links.union(found)
        side = lambda c: parts.select(F.col("id").alias(f"{c}_id"), F.col("part").alias(f"{c}_part"))
        joined = found.join(side("a"), F.col("a") == F.col("a_id")).join(side("b"), F.col("b") == F.col("b_id"))
        place = stage(components(joined.select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))), "near-merged")
        moved, were = place.where("node <> component").count(), held.agg(F.count_distinct("part")).first()[0]
        if not moved:
            break
        merged = lambda df: df.join(place, F.col("part") == F.col("node"), "left").withColumn("part", F.coalesce("component", "part")).drop("node", "component")  # noqa: E731, B023
        parts = stage(merged(parts), "near-parts")
        held = _mixed(merged(held).drop("largest"))
        if moved * ROUND_SHARE < were:
            break
    return links.union(confirmed(across(held, members, numerator, denominator), sets, numerator, denominator))


def _held(batch, rows: list[int], sets: list[np.ndarray], numerator: int, denominator: int) -> pa.RecordBatch:
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    classes = [_partner_classes(len(s), numerator, denominator) if len(s) else range(0) for s in sets]
    parities = [_parity(s.view(np.uint64), c) for s, own in zip(sets, classes, strict=True) for c in own]
    cuts = np.concatenate([[0], np.cumsum([len(own) for own in classes])]).astype(np.int32)
    inner = np.concatenate([[0], np.cumsum([len(p) for p in parities])]).astype(np.int32)
    bits = pa.ListArray.from_arrays(pa.array(inner), pa.array(np.concatenate(parities) if parities else np.zeros(0, np.int64)))
    own_rows = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(own_rows), batch.column(1).take(own_rows),
            pa.array([_name(s.view(np.uint64)) for s in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
            pa.array([own.start for own in classes], pa.int32()), pa.ListArray.from_arrays(pa.array(cuts), bits),
        ],
        names=["doc_id", "text_hash", "id", "shingles", "low", "parities"],
    )


def near_groups(
    docs: DataFrame, numerator: int = 85, denominator: int = 100, words: int = WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links), kept."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketched = stage(sketch(docs, words), "near-sketch")
    filled = sketched.where("n_shingles > 0")
    # A class is read again from one row of it: that of the smallest id, of rows of one id that of the smallest hash.
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    copies = filled.groupBy("id", "doc_id", "text_hash").agg(F.count("*").alias("copies"), F.min("tokens").alias("tokens"))
    classes = stage(
        copies.groupBy("id").agg(F.min_by(F.struct("doc_id", "text_hash", "copies"), row).alias("r"), F.min("tokens").alias("tokens"))
        .select("id", "r.*", "tokens"),
        "near-classes",
    )
    posted = stage(post(classes), "near-postings")

    head = F.min(F.struct((-F.col("common")).alias("rank"), "id"))
    lists = stage(posted.groupBy("token").agg(F.count("*").alias("n"), head["id"].alias("first")).where("n > 1"), "near-lists")
    heads = lists.select(F.col("token").alias("l_token"), "first")
    own = posted.select(F.col("token").alias("h_token"), F.col("id").alias("h_id"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))
    heads = stage(own.join(heads, (F.col("h_token") == F.col("l_token")) & (F.col("h_id") == F.col("first")), "inner"), "near-heads")
    to_head = posted.join(heads, (F.col("token") == F.col("h_token")) & (F.col("id") != F.col("h_id")) & _alike())
    pairs = stage(to_head.select(F.least("h_id", "id").alias("a"), F.greatest("h_id", "id").alias("b")).distinct(), "near-pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    links = confirmed(pairs, full_sets(docs, classes, ids, words), numerator, denominator)

    place = stage(components(links), "near-first-components")
    in_lists = posted.join(lists.select(F.col("token").alias("l_token")), F.col("token") == F.col("l_token"), "left_semi")
    labelled = stage(
        in_lists.join(place, F.col("id") == F.col("node"), "left").select("token", "id", F.coalesce("component", "id").alias("part")),
        "near-labelled",
    )
    mixed = labelled.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select(F.col("token").alias("m_token"))
    open_ = stage(
        labelled.join(mixed, F.col("token") == F.col("m_token"), "left_semi").select("id", "part").distinct(),
        "near-open-ids",
    )
    sets = full_sets(docs, classes, open_.select("id"), words, numerator, denominator)
    members = stage(sets.select("id", "low", "parities").join(open_, "id").select("id", "part", "low", "parities"), "near-members")
    links = links.union(links_across(sets, members, numerator, denominator))

    found = stage(components(links), "near-components")
    named = stage(
        classes.join(found, F.col("id") == F.col("node"), "left").select("id", "doc_id", F.coalesce("component", "id").alias("component")),
        "near-named",
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("component", "s_component")
    where = stage(
        named.join(smallest, F.col("component") == F.col("s_component")).select(F.col("id").alias("w_id"), "component_id"), "near-places"
    )
    grouped = filled.join(where, F.col("id") == F.col("w_id")).select("doc_id", "n_shingles", "component_id")
    empty = sketched.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
