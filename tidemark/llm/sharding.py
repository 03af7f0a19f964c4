"""Sharding by extendible hashing, in DataFrame operations only.

A row's hash is 32 bits of the md5 of its key. The directory is indexed by hash prefixes; a bucket
that exceeds the byte limit splits on one more bit, all others stay as they are, until every shard
fits. Bytes are summed per prefix of the deepest level tried so far, and the depth of a shard is the
first at which its prefix fits; only prefixes that are still too large there are counted again with
more bits. Texts are read twice: once for their sizes, once to be written.

The directory has an entry for each value of the first g bits, 2^g being about the number of shards; an
entry lists the shards of these bits, one for most, several where buckets split further. Rows look up
their entry by one equi-join, which the planner broadcasts or shuffles by the directory's size, are dealt
out by (shard, page) and written to the folder of that name, with all their columns.

A shard of one key (all bits used, or repeated ids) cannot split. It gets overflow pages, as buckets
of equal hashes do: rows fill pages within (hash, input partition) by running sums, and each such run's pages
are numbered behind those of the runs before it, so that no task sees a whole group. Such rows are
shuffled once more than others.

Defined results: null text has 0 bytes; a null key hashes like the empty text; repeated rows are
placed one by one; a row larger than the limit has a page to itself; an empty table gives no rows;
columns of any name are kept, as fields of the column row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored
from tidemark.session import run_dir

LIMIT = 64 << 20
HASH_BITS = 32
STEP = 6  # bits by which a prefix that is too large is looked into


def key_hash(key: Column) -> Column:
    """The first 32 bits of the key's md5 as a long."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _prefix(depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", F.col("hash"), (F.lit(HASH_BITS) - depth).cast("int"))


def directory(sized: DataFrame, limit: int) -> DataFrame:
    """prefix, depth and bytes of each shard. sized: hash and bytes per row.

    Shards that are too large at full depth are in it too, with all bits as their prefix.
    """
    open_rows, shards, depth = sized, [], 0
    while True:
        level = min(depth + STEP, HASH_BITS)
        leaves = open_rows.groupBy(_prefix(level).alias("leaf")).agg(
            F.sum("bytes").alias("bytes")
        )
        # The leaves are few: at most 2^STEP for each bucket that was too large.
        steps = F.sequence(F.lit(depth if depth == 0 else depth + 1), F.lit(level))
        nodes = (
            leaves.select("leaf", "bytes", F.explode(steps).alias("depth"))
            .withColumn(
                "prefix",
                F.call_function("shiftright", F.col("leaf"), F.lit(level) - F.col("depth")),
            )
            .groupBy("depth", "prefix")
            .agg(F.sum("bytes").alias("bytes"))
        )
        # A node is a shard if it fits and its parent does not. Below a fitting node there is none.
        parent = nodes.select(
            (F.col("depth") + 1).alias("depth"),
            F.col("prefix").alias("parent"),
            (F.col("bytes") > limit).alias("split"),
        )
        half = F.shiftright("prefix", 1)
        placed = nodes.withColumn("parent", half).join(parent, ["depth", "parent"], "left")
        reached = F.coalesce("split", F.lit(True))
        fits = F.col("bytes") <= limit
        here = placed.where(reached & (fits | (F.col("depth") == level)))
        here = stored(here.select("prefix", "depth", "bytes", fits.alias("fits")), "directory")
        at_end = level == HASH_BITS
        shards.append(here if at_end else here.where("fits"))
        crowded = here.where("NOT fits").select(F.col("prefix").alias("leaf"))
        if at_end or crowded.isEmpty():
            break
        open_rows = open_rows.withColumn("leaf", _prefix(level)).join(crowded, "leaf", "left_semi")
        depth = level
    return reduce(DataFrame.unionByName, shards).select("prefix", "depth", "bytes", "fits")


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits.cast("int"))


def entries(shards: DataFrame, g: int) -> DataFrame:
    """The directory by the first g bits: entry and the shards that hold rows of it."""
    own = F.struct("prefix", "depth", "fits").alias("shard")
    deeper = F.col("depth") - g
    low = F.col("prefix") * F.lit(2).cast("long") ** F.greatest(-deeper, F.lit(0))
    low = low.cast("long")
    width = (F.lit(2) ** F.greatest(-deeper, F.lit(0))).cast("long")
    first = F.when(deeper > 0, _shift(F.col("prefix"), F.greatest(deeper, F.lit(0)))).otherwise(low)
    last = F.when(deeper > 0, first).otherwise(low + width - 1)
    # A shard of fewer bits than g has several entries, at most 2^g in all.
    each = shards.select(F.explode(F.sequence(first, last)).alias("entry"), own)
    return each.groupBy("entry").agg(F.collect_list("shard").alias("shards"))


def placed(docs: DataFrame, limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    """row (all columns of docs), shard (the bits of its prefix) and page for each row.

    Dealt by (shard, page) to about as many partitions as there are of these, whatever the session's
    number, so that a task's share doesn't grow with the table.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    hashed = key_hash(F.col(key))
    sized = stored(docs.select(hashed.alias("hash"), size.alias("bytes")), "sized")
    shards = stored(directory(sized, limit), "shards")
    # About as many entries as shards, and none deeper than the deepest shard.
    known = shards.agg(F.count(F.lit(1)), F.max("depth"), F.sum("bytes")).first()
    parts = max(1, known[0], -(-2 * (known[2] or 0) // limit))
    g = min(max(known[0] - 1, 0).bit_length(), known[1] or 0)
    # A row's place in its input tells apart rows that are equal in everything else.
    rows = docs.select(
        F.struct("*").alias("row"),
        hashed.alias("hash"),
        size.alias("bytes"),
        F.monotonically_increasing_id().alias("place"),
    )
    own = F.filter(
        "shards", lambda x: _shift(F.col("hash"), F.lit(HASH_BITS) - x["depth"]) == x["prefix"]
    )
    found = (
        rows.withColumn("entry", _prefix(g))
        .join(entries(shards, g), "entry")
        .select("row", "hash", "bytes", "place", F.get(own, F.lit(0)).alias("own"))
        .select("row", "hash", "bytes", "place", "own.prefix", "own.depth", "own.fits")
    )
    calm = found.where("fits").withColumn("page", F.lit(0).cast("long"))
    paged = _paged(found.where("NOT fits"), limit)
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.substring(
            F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), HASH_BITS, "0"),
            (F.lit(HASH_BITS + 1) - F.col("depth")).cast("int"),
            F.col("depth"),
        )
    )
    whole = calm.unionByName(paged.select(calm.columns))
    return whole.select("row", bits.alias("shard"), "page").repartition(parts, "shard", "page")


def write_shards(
    docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id"
) -> None:
    """Write the rows of docs to path/shard=<bits>/page=<n>, a shard's page by one task."""
    placed(docs, limit, key).write.partitionBy("shard", "page").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """row, shard and page of what was written; schema: that of the documents."""
    # Bits are text, not a number; the one shard without bits has a folder without a value.
    kinds = T.StructType().add("row", schema).add("shard", "string").add("page", "long")
    rows = spark.read.schema(kinds).parquet(path)
    return rows.withColumn("shard", F.coalesce("shard", F.lit("")))


def shard(docs: DataFrame, limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    """key, n_bytes, shard, depth, page and shard_bytes for each row, read from the written shards."""
    spark = docs.sparkSession
    path = run_dir(spark, "shards")
    write_shards(docs, path, limit, key)
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    rows = read_shards(spark, path, docs.schema).select(
        F.col("row")[key].alias(key), size.alias("n_bytes"), "shard", "page"
    )
    totals = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return rows.join(totals, "shard").select(
        key, "n_bytes", "shard", F.length("shard").alias("depth"), "page", "shard_bytes"
    )


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of shards that cannot split, dealt to pages of at most limit bytes.

    Each run of an input partition within a hash fills pages of its own, so that a running sum
    never spans partitions; a page is closed when the next row would exceed the limit.
    """
    run = ["hash", "run"]
    numbered = rows.withColumn("run", F.shiftright("place", 33))
    # Half the limit per page by running sums keeps any page, with its last row, within the limit;
    # rows above half the limit are alone.
    half = max(1, limit // 2)
    small = numbered.where(F.col("bytes") <= half)
    large = numbered.where(F.col("bytes") > half)
    before = F.sum("bytes").over(
        Window.partitionBy(*run).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    small = small.withColumn("own", F.floor(F.coalesce(before, F.lit(0)) / half).cast("long"))
    large = large.withColumn(
        "own", F.row_number().over(Window.partitionBy(*run).orderBy("place")).cast("long") - 1
    )
    parts = small.withColumn("kind", F.lit(0)).unionByName(large.withColumn("kind", F.lit(1)))
    used = parts.groupBy(*run, "kind").agg((F.max("own") + 1).alias("pages"))
    offset = F.sum("pages").over(
        Window.partitionBy("hash").orderBy("run", "kind").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = used.select(*run, "kind", F.coalesce(offset, F.lit(0)).alias("offset"))
    return (
        parts.join(offsets, [*run, "kind"])
        .withColumn("page", F.col("offset") + F.col("own"))
        .drop("offset", "own", "kind", "run")
    )
