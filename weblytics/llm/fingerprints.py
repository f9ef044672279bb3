"""Operator 8, document fingerprints: weighted SimHash and search by permuted block tables.

Terms are pairs of neighbouring words, lower-cased, and the last word; a term's weight is the number of
times it occurs. Each occurrence votes on 64 bits; votes are summed two to a long, 32 bits apart,
so 32 sums do, and no text can be long enough to overflow one.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblytics.llm.common import join_counted, texts, written

PAIR = 0x100000001  # one vote for bit i and one for bit i + 32
LOW = 0xFFFFFFFF
SPACES = r"[\x20\x09-\x0D]+"
NO_ID = (1 << 63) - 1
BLOCKS = 6
BUCKETS_PER_PARTITION = 4


def term_hashes(text: Column) -> Column:
    words = F.split(F.lower(text), SPACES)
    return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))


def votes() -> list[Column]:
    return [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(PAIR)).alias(f"v{i}") for i in range(32)]


def from_votes(count: Column) -> Column:
    """A bit is set if more than half the weight voted for it."""
    bits = []
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(LOW), F.shiftrightunsigned(f"v{i}", 32)
        bits += [F.shiftleft((2 * low > count).cast("bigint"), i)]
        bits += [F.shiftleft((2 * high > count).cast("bigint"), i + 32)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def likeness(a: Column, b: Column) -> Column:
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def _bucket(value: Column, bounds: list[int]) -> Column:
    """Number of the last bound not above ``value``, by binary search."""
    powers = [1 << k for k in reversed(range(max(1, len(bounds).bit_length())))]
    table = F.lit(bounds)

    def step(at: Column, power: Column) -> Column:
        bound = F.get(table, at + power)
        return F.when(bound <= value, at + power).otherwise(at)

    return F.aggregate(F.lit(powers), F.lit(0), step)


def with_next(rows: DataFrame) -> DataFrame:
    """Rows of (doc_id, text) in buckets of neighbouring ids, each with its follower's text.

    Bucket bounds are ids, one approximate quantile for each bucket, so their number follows the shuffle
    partitions. The first document of a bucket is copied to the one before (of the first: to the last
    one), marked ``copy``, so each follower is in the same bucket. Texts are shuffled once.
    """
    spark = rows.sparkSession
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    n = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(
        F.min("id").alias("least"), F.percentile_approx("id", [i / n for i in range(n)], 10 * n).alias("cuts")
    ).first()
    bounds = sorted({found["least"], *found["cuts"]}) if found["cuts"] else [0]
    at = _bucket(F.col("id"), bounds)
    places = F.when(
        F.col("id") == F.get(F.lit(bounds), F.col("at")),
        F.array(
            F.struct(F.col("at").alias("bucket"), F.lit(False).alias("copy")),
            F.struct(F.pmod(F.col("at") - 1, F.lit(len(bounds))).alias("bucket"), F.lit(True).alias("copy")),
        ),
    ).otherwise(F.array(F.struct(F.col("at").alias("bucket"), F.lit(False).alias("copy"))))
    dealt = (
        rows.withColumn("at", at)
        .withColumn("place", F.explode(places))
        .select("doc_id", "id", "text", "place.bucket", "place.copy", F.xxhash64("text").alias("mark"))
    )
    order = Window.partitionBy("bucket").orderBy("copy", "id", "mark")
    return dealt.withColumns({"turn": F.row_number().over(order), "next": F.lead("text").over(order)})


def fingerprint_documents(docs: DataFrame, **names: str) -> DataFrame:
    """One row for each row: doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp.

    The edited text has its last half replaced by the start of the next document, by id. A null text is
    empty; null ids come last; rows with one id follow each other by a hash of the text, and rows equal
    in that too are interchangeable. A single row is its own follower. An empty table gives no rows.
    """
    half = F.expr("n_chars div 2")
    rows = with_next(texts(docs, **names)).withColumn("n_chars", F.char_length("text").cast("bigint"))
    both = rows.withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
            F.substring(F.coalesce("next", F.lit("")), F.lit(1), half.cast("int")),
        ),
    ).select(
        "bucket", "turn", "copy", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text")),
                          F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("form"),
    )
    keys = ["bucket", "turn", "copy", "doc_id", "n_chars", "edited_sha256"]
    voted = (
        both.select(*keys, "form.which", F.explode(term_hashes(F.col("form.text"))).alias("h"))
        .groupBy(*keys, "which")
        .agg(F.count("h").alias("terms"), *votes())
        .select(*keys, "which", from_votes(F.col("terms")).alias("print"))
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("which") == 0, F.col("print"))).alias("fp"),
            F.max(F.when(F.col("which") == 1, F.col("print"))).alias("edited_fp"),
        )
    )
    follower = F.lead("fp").over(Window.partitionBy("bucket").orderBy("turn"))
    return voted.withColumn("next_fp", follower).where(~F.col("copy")).drop("bucket", "turn", "copy")


def block_masks(radius: int, blocks: int = BLOCKS) -> list[int]:
    """One mask for each table: the bits of ``blocks - radius`` blocks, which some near pair agrees in."""
    if not 0 <= radius < blocks:
        raise ValueError("radius must be below the number of blocks")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    spans = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    masks = [sum(c) for c in combinations(spans, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_fingerprints(queries: DataFrame, known: DataFrame, radius: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """All pairs ``q, fp`` of a query and a known fingerprint within ``radius`` bits.

    Both frames have distinct ``fp``. Two fingerprints within the radius differ in ``radius`` blocks at
    most, so they agree in all blocks of some table; candidates are verified by counting bits.
    """
    masks = F.lit(block_masks(radius, blocks))

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = F.transform(masks, lambda m: F.col("print").bitwiseAND(m))
        return df.select(F.col("fp").alias("print")).select(
            F.col("print").alias(name), F.posexplode(keys).alias("table", "key")
        )

    return (
        tables(queries, "q")
        .join(tables(known, "fp"), ["table", "key"])
        .where(F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius)
        .select("q", "fp")
        .distinct()
    )


def with_near_counts(prints: DataFrame, is_query: Column, radius: int = 3) -> DataFrame:
    """Add ``near_documents``: for query rows the rows within ``radius``, themselves included; else null."""
    known = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("rows"))
    asked = prints.where(is_query).groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    asked = written(asked, "queries")
    counts = (
        near_fingerprints(asked.select("fp"), known.select("fp"), radius)
        .join(known, "fp")
        .groupBy(F.col("q").alias("fp"))
        .agg(F.sum("rows").alias("near_documents"))
    )
    answered = join_counted(
        prints.where(is_query), written(asked.join(counts, "fp"), "near"), ["fp"]
    ).drop("n")
    rest = prints.where(~F.coalesce(is_query, F.lit(False))).withColumn("near_documents", F.lit(None).cast("bigint"))
    return answered.unionByName(rest)


def signatures(docs: DataFrame, **names: str) -> DataFrame:
    """The rows of ``fingerprint_documents``, written once because several searches read them."""
    return written(fingerprint_documents(docs, **names), "prints")
