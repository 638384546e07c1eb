"""Exact duplicates by deterministic block naming.

A text's UTF-8 bytes are cut into blocks of a fixed size. Distinct blocks are sorted and numbered:
equal blocks get one integer name, different blocks different ones. Then adjacent pairs of names
are named in the same way, level by level, until each document has a single name. Texts are equal
if and only if they end at the same level with the same name; no hash decides it.

Only the first level moves text, once for the distinct blocks and once for the look-up; each further
level moves two integers per row, half as many rows as the level below. A value that holds a large
share of all rows is never gathered: its rows look their name up in a broadcast table, which has at
most ``HOT_VALUES`` rows by construction, and the others are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foghorn.llm.common import text_of
from foghorn.session import materialise

BLOCK_BYTES = 2048
#: A value is hot when it has over HOT_VALUES rows more than one in HOT_VALUES, so there are fewer than that.
HOT_VALUES = 512


def with_group_values(rows: DataFrame, keys: list[str], values: list[Column], number: str | None = None) -> DataFrame:
    """Each row with aggregates over its group of equal, non-null ``keys``.

    With ``number``, also a column of that name with an integer for each group: groups are sorted
    within their partition and numbered in order. Hot groups are found by counting hashes (a row per
    hash and task is all that moves); their aggregates are broadcast, the other rows are joined.
    """
    if number in rows.columns or "_h" in rows.columns:
        raise ValueError("column names _h and the number's are taken")
    rows = rows.withColumn("_h", F.xxhash64(*keys))
    counted = rows.groupBy("_h").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    hot = [
        r[0]
        for r in counted.join(F.broadcast(total), F.col("n") * HOT_VALUES > F.col("total") + HOT_VALUES * HOT_VALUES)
        .select("_h")
        .limit(HOT_VALUES)
        .collect()
    ]

    def grouped(part: DataFrame, sign: int) -> DataFrame:
        out = part.groupBy(*keys).agg(*values, *([] if values else [F.lit(1).alias("_one")]))
        out = out if values else out.drop("_one")
        if number:
            place = F.monotonically_increasing_id()
            out = out.sortWithinPartitions(*keys)
            out = out.withColumn(number, place + 1 if sign > 0 else -place - 1)
        return out

    cold = rows if not hot else rows.filter(~F.col("_h").isin(hot))
    out = cold.join(grouped(cold, 1), keys)
    if hot:
        warm = rows.filter(F.col("_h").isin(hot))
        out = out.unionByName(warm.join(F.broadcast(grouped(warm, -1)), keys))
    return out.drop("_h")


def document_names(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``row`` (its number), ``sha`` and the identity (``level``, ``name``).

    Null counts as the empty text, which is one empty block.
    """
    text = text_of(text_col).cast("binary")
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text")
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes)).cast("int")
    source = source.withColumns({"blocks": blocks, "sha": F.unhex(F.sha2("text", 256))})
    cut = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.substring(F.col("text"), i * block_bytes + 1, F.lit(block_bytes)),
    )
    level = source.select("doc_id", "row", "blocks", "sha", F.posexplode(cut).alias("at", "block"))
    first = F.col("at") == 0
    level = level.withColumns(
        {c: F.when(first, F.col(c)) for c in ("doc_id", "sha")}  # carried by one row of each document
    )
    named = with_group_values(level, ["block"], [], number="name").drop("block")
    named = materialise(named)
    depth = 0
    done = named.filter("blocks = 1").select("doc_id", "row", "sha", F.lit(depth).alias("level"), "name")
    finished = [done]
    rest = named.filter("blocks > 1")
    while not rest.isEmpty():
        depth += 1
        # the pair of a block is complete in the group of (row, at / 2): two rows at most
        pairs = rest.groupBy("row", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
            F.max("doc_id").alias("doc_id"),
            F.max("sha").alias("sha"),
            F.max("blocks").alias("blocks"),
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(0)).alias("right"),
        )
        pairs = pairs.withColumn("blocks", F.ceil(F.col("blocks") / 2).cast("int"))
        named = materialise(with_group_values(materialise(pairs), ["left", "right"], [], number="name"))
        named = named.drop("left", "right")
        finished.append(
            named.filter("blocks = 1").select("doc_id", "row", "sha", F.lit(depth).alias("level"), "name")
        )
        rest = named.filter("blocks > 1")
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return out


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; of rows that also share the id, exactly one.
    Null texts equal the empty text. A null id is smaller than any other. An empty table gives no
    rows. Other columns of the input are dropped, whatever their names.
    """
    names = document_names(docs, id_col, text_col, block_bytes)
    best = F.max(F.struct(F.col("doc_id"), F.col("row"))).alias("best")
    size = F.count(F.lit(1)).alias("group_size")
    return with_group_values(names, ["level", "name"], [best, size]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A kept id and text digest pick the row; of rows that share both, the one whose other columns
    hash lowest stays.
    """
    from pyspark.sql import Window

    kept = exact_duplicates(docs, id_col, text_col).filter("kept")
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    data = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).alias("_id"),
        F.sha2(text_of(text_col).cast("binary"), 256).alias("_sha"),
    )
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha"))
    data = data.join(kept, same, "left_semi")
    order = Window.partitionBy("_id", "_sha").orderBy(F.xxhash64("_row"))
    return data.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("_row.*")
