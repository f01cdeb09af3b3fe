"""SimHash fingerprints and the search for all fingerprints within a Hamming
radius through permuted block tables.

Every term of a text (two neighbouring words, one vote per occurrence, so a
term's weight is its frequency) votes with its 64-bit hash: bit b of the
fingerprint is 1 if more than half of the votes have bit b. Votes are summed
two bits to a long (``(h >> b) & 0x0000000100000001``), 32 sums in place of 64.

Search: 64 bits in 6 blocks; fingerprints within radius 3 differ in at most 3
blocks, so they agree on some choice of 3 blocks. Each choice is one table
keyed by those blocks (20 tables, keys of 31 bits and more); candidates are
verified by the Hamming distance. Copies of a fingerprint are one row there.

DataFrame functions only.

Defined cases: a null text is empty; a text without words has the fingerprint
0; a one-word text has that word as its term; repeated rows are kept, each
with its own row; null ids come first; ties of the id are ordered by text; an
empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.common import ASCII_SPACE, materialise

BITS, HALF = 64, 32
BLOCKS, RADIUS = 6, 3
EDGES = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
SPREAD = 0x0000000100000001
QUANTILES = 64                  # of the ids, for the order of rows


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), ASCII_SPACE + "+"), lambda w: w != "")


def term_hashes(words: Column) -> Column:
    """Hashes of neighbouring words; a single word by itself; no word: 0."""
    pairs = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))
    return F.when(F.size(words) > 1, F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(1)))) \
        .when(F.size(words) == 1, pairs).otherwise(F.array(F.lit(0).cast("bigint")))


def count_votes(exploded: DataFrame, keys: list[str], term: str) -> DataFrame:
    """Votes per key: partial sums come before the shuffle, so one row per key
    and task moves, however long a text is."""
    sums = [F.sum(F.shiftright(term, b).bitwiseAND(F.lit(SPREAD))).alias(f"_v{b}") for b in range(HALF)]
    return exploded.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums)


def fingerprint() -> Column:
    """The 64 bits from the columns of ``count_votes``."""
    def bit(count: Column, at: Column) -> Column:
        # a shift by an expression has no Python function with a column argument
        return F.when(count * 2 > F.col("_n"), F.call_function("shiftleft", F.lit(1).cast("bigint"), at)) \
            .otherwise(F.lit(0).cast("bigint"))
    words = F.transform(F.array(*(F.col(f"_v{b}") for b in range(HALF))), lambda v, i: bit(
        v.bitwiseAND(F.lit(0xFFFFFFFF)), i).bitwiseOR(bit(F.shiftrightunsigned(v, HALF), i + HALF)))
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda a, w: a.bitwiseOR(w))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(f: Column) -> Column:
    return F.lower(F.lpad(F.hex(f), 16, "0"))


def block_tables(f: str) -> Column:
    """One (table, key) per choice of blocks that agree."""
    tables = []
    for t, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS)):
        mask = sum(((1 << (EDGES[i + 1] - EDGES[i])) - 1) << EDGES[i] for i in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        tables.append(F.struct(F.lit(t).alias("t"),
                               F.col(f).bitwiseAND(F.lit(mask).cast("bigint")).alias("k")))
    return F.array(*tables)


def search(queries: DataFrame, prints: DataFrame) -> DataFrame:
    """For every distinct fingerprint ``fp`` of ``queries``: the number of rows
    of ``prints`` (column ``fp``) within the radius, equal ones included."""
    held = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("rows"))
    index = held.select(F.col("fp").alias("g"), "rows", F.explode(block_tables("fp")).alias("s")) \
        .select("g", "rows", "s.t", "s.k")
    asked = queries.select("fp").distinct().select("fp", F.explode(block_tables("fp")).alias("s")) \
        .select("fp", "s.t", "s.k")
    found = asked.join(index, ["t", "k"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("g"))) <= RADIUS)
    # a pair may meet in several tables
    return found.groupBy("fp", "g").agg(F.first("rows").alias("rows")) \
        .groupBy("fp").agg(F.sum("rows").alias("n_near"))


def with_range(rows: DataFrame, source: DataFrame, id_col: str, ranges: int) -> DataFrame:
    """``rows`` (column ``doc_id``) with ``range``, a number that grows with the id and
    deals rows into about ``ranges`` even groups: the id's quantile in ``source``, then
    even steps inside it. Null: -1."""
    x = F.col(id_col).cast("bigint")
    row = source.agg(F.min(x).alias("a"), F.max(x).alias("b"), F.percentile_approx(
        x, [i / QUANTILES for i in range(1, QUANTILES)], 100 * QUANTILES).alias("c")).first()
    if row["a"] is None:
        return rows.withColumn("range", F.lit(-1).cast("bigint"))
    edges = sorted({*row["c"]} - {row["b"]})
    table = F.array(*(F.lit(e).cast("bigint") for e in [row["a"] - 1, *edges, row["b"]]))
    steps = max(1, ranges // QUANTILES)
    below = F.size(F.filter(F.array(*(F.lit(e).cast("bigint") for e in edges)) if edges else F.array().cast("array<bigint>"),
                            lambda e: e < F.col("doc_id")))
    at = rows.withColumn("_at", F.when(F.col("doc_id").isNotNull(), below))
    at = at.withColumn("_low", F.get(table, F.col("_at")).cast("double")) \
        .withColumn("_high", F.get(table, F.col("_at") + 1).cast("double"))
    inside = F.least(F.floor((F.col("doc_id") - F.col("_low") - 1) * steps
                             / F.greatest(F.col("_high") - F.col("_low"), F.lit(1.0))), F.lit(steps - 1))
    number = F.when(F.col("_at").isNotNull(), (F.col("_at") * steps + inside).cast("bigint"))
    return at.withColumn("range", F.coalesce(number, F.lit(-1).cast("bigint"))).drop("_at", "_low", "_high")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row (``doc_id``, ``text``), its place (``range``, ``nr``) in ascending
    order of the id, and text and place of the next row (after the last: the
    first). Only the first row of a range is looked up from outside it."""
    spark = docs.sparkSession
    rows = with_range(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")),
                      docs, id_col, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    firsts = rows.groupBy("range").agg(F.min("doc_id").alias("first_id"))
    # one row of three numbers per range, so both the window and the broadcast are as
    # small as the number of ranges
    order, ring = Window.orderBy("range"), Window.orderBy("range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    follow = firsts.select("range", "first_id", F.coalesce(
        F.lead("range").over(order), F.first("range").over(ring)).alias("after"))
    texts = rows.join(F.broadcast(firsts.select(F.col("range").alias("r"), "first_id")),
                      (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("first_id"))) \
        .groupBy("range").agg(F.min(F.coalesce("text", F.lit(""))).alias("first_text"))
    after = follow.select("range", "after").join(
        texts.select(F.col("range").alias("after"), "first_text"), "after")
    w = Window.partitionBy("range").orderBy("doc_id", "text")
    seen = rows.withColumn("text", F.coalesce("text", F.lit(""))).select(
        "*", F.row_number().over(w).alias("nr"), F.lead("text").over(w).alias("follower"))
    last = F.col("follower").isNull()
    return seen.join(after, "range").select(
        "range", "nr", "doc_id", "text", F.coalesce("follower", "first_text").alias("next_text"),
        F.when(last, F.col("after")).otherwise(F.col("range")).alias("next_range"),
        F.when(last, F.lit(1)).otherwise(F.col("nr") + 1).alias("next_nr"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("w"))
    long = rows.select("doc_id", "row", F.explode(term_hashes(F.col("w"))).alias("h"))
    return count_votes(long, ["doc_id", "row"], "h").select("doc_id", fingerprint().alias("fp"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text (the last quarter of
    its characters replaced by the next document's first) and the next document's."""
    rows = with_next(docs, id_col, text_col)
    rows = rows.select("*", F.char_length("text").cast("bigint").alias("n_chars"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.select("*", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter),
                                     F.substring("next_text", F.lit(1), quarter)).alias("edited"))
    keys = ["range", "nr", "next_range", "next_nr", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.select(*keys[:-1], F.sha2("edited", 256).alias(keys[-1]),
                       words_of(F.col("text")).alias("a"), words_of(F.col("edited")).alias("b"))
    rows = rows.select(*keys, term_hashes(F.col("a")).alias("a"), term_hashes(F.col("b")).alias("b"))
    long = rows.select(*keys, F.size("a").alias("n"), F.posexplode(F.concat("a", "b")).alias("pos", "h")) \
        .select(*keys, (F.col("pos") >= F.col("n")).alias("is_edited"), "h")
    prints = materialise(count_votes(long, [*keys, "is_edited"], "h").select(
        *keys, "is_edited", fingerprint().alias("fp")), "simhash")
    own = prints.groupBy(*keys).agg(F.max(F.when(~F.col("is_edited"), F.col("fp"))).alias("fp"),
                                    F.max(F.when(F.col("is_edited"), F.col("fp"))).alias("edited_fp"))
    following = prints.filter(~F.col("is_edited")).select(
        F.col("range").alias("next_range"), F.col("nr").alias("next_nr"), F.col("fp").alias("next_fp"))
    return own.join(following, ["next_range", "next_nr"]).select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def report(docs: DataFrame, queries_every: int = 50) -> DataFrame:
    """``edited_likeness`` with hex fingerprints and shares of equal bits; rows
    whose id is divisible by ``queries_every`` are also searched: ``n_near`` is the
    number of rows whose fingerprint lies within the radius (its own included)."""
    rows = materialise(edited_likeness(docs), "simhash-rows")
    is_query = F.coalesce(F.col("doc_id") % queries_every == 0, F.lit(False))
    near = search(rows.filter(is_query), rows)
    asked = rows.withColumn("q", F.when(is_query, F.col("fp")))
    return asked.join(near.select(F.col("fp").alias("q"), "n_near"), "q", "left").select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "n_near")
