"""Item-to-item cosine similarity from (user, item, rating) rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.joins import by_size, lookup, pairs_of_large, split_join
from loomframe.operators.ordering import top_k


def _score(rating1: Column, rating2: Column) -> list[Column]:
    dot = F.sum(rating1 * rating2)
    norms = F.sqrt(F.sum(rating1 * rating1)) * F.sqrt(F.sum(rating2 * rating2))
    score = F.when(norms != 0, dot / norms).otherwise(0.0)
    return [score.alias("score"), F.count(rating1 * rating2).alias("num_pairs")]


#: Items with more than this share of all ratings, at most 1,000, have their pairs folded before they are shuffled.
OFTEN = 1e-3
#: Pairs that a task sums at a time, unless one item has more different ones.
CHUNK = 1 << 20
#: Types of items whose pairs are summed in Arrow, which tells their values apart as Spark does.
PLAIN = ("tinyint", "smallint", "int", "bigint", "string", "date")


def item_similarity(
    ratings: DataFrame, user: str, item: str, rating: str, min_pairs: int = 1, block: int = 2048, rounds: int = 1
) -> DataFrame:
    """Cosine score and number of common users for every pair of items.

    Returns ``item1 < item2``, ``score``, ``num_pairs``, for pairs with at least
    ``min_pairs`` pairs of ratings by one user. A user who rated an item several times
    gives as many pairs, so an item rated once can be in a pair with more.

    With ``min_pairs`` items that cannot be in such a pair are left out before pairs are
    formed, in ``rounds`` rounds (see ``could_reach``); the result is the same. A least
    score does not help there: two items with proportional ratings by their common users
    score 1 whatever else they were rated.

    The ratings of a user travel to the task of each of their items as a list of those of larger
    items, a few bytes for each pair. There they are sorted by item, multiplied and summed an item at
    a time, so a task holds the sums of one item and not those of all its pairs. Pairs whose
    smaller item is rated very often (``OFTEN``) and those of large users are folded into partial
    sums in the task that forms them, so no item fills a task. Integer ratings keep the sums exact.
    """
    rows = ratings.select(user, item, F.col(rating).cast(_sum_type(ratings, rating)).alias(rating))
    if min_pairs > 1:
        rows = could_reach(rows, user, item, min_pairs, rounds)
    light, large = by_size(rows, user, item, rating, block)
    lists = _lists(light, user)
    # Every column is counted, so that this reads the shuffle that the lists read.
    n_rows = F.count("value") + F.count_if(F.col("value").isNull()) + F.count_if(F.col(user).isNull())
    counts = rows.where(F.col(user).isNotNull() & F.col(item).isNotNull()).select(
        F.col(user), F.col(item).alias("item1"), F.col(rating).alias("value")
    ).groupBy("item1").agg(n_rows.alias("_n"))
    often = F.broadcast(counts.where(F.col("_n") > counts.agg(F.sum("_n")).scalar() * F.lit(OFTEN)).select("item1"))
    sent = lists.join(often, "item1", "left_anti")
    kept = [F.col(c) for c in ("item1", "item2", "value1", "value2")]
    formed = _unlisted(lists.join(often, "item1")).select(*kept)
    formed = formed.unionAll(pairs_of_large(large, user, True, block).select(*kept))
    folded = formed.groupBy("item1", "item2").agg(*_sums(F.col("value1"), F.col("value2")))
    folded = folded.select("item1", F.array("item2").alias("far"), F.struct("xy", "xx", "yy", "n").alias("folded"))
    # One shuffle by the smaller item brings together whatever belongs to a pair.
    met = sent.unionByName(folded, allowMissingColumns=True).repartition("item1")
    if dict(met.dtypes)["item1"] in PLAIN:
        kind, number = dict(met.dtypes)["item1"], dict(met.dtypes)["value1"]
        schema = f"item1 {kind}, item2 {kind}, xy {number}, xx {number}, yy {number}, n long"
        merged = met.sortWithinPartitions("item1").mapInArrow(_sum_lists(min_pairs, CHUNK), schema)
    else:
        x, y = F.col("value1"), F.col("value2")
        terms = {"xy": x * y, "xx": x * x, "yy": y * y, "n": (x * y).isNotNull().cast("long")}
        # Of a list, a rating that meets a NULL counts for its own norm, as in pairs.
        either = {t: F.when(F.col("folded").isNull(), c).otherwise(F.col(f"folded.{t}")) for t, c in terms.items()}
        merged = _unlisted(met).groupBy("item1", "item2").agg(*[F.sum(c).alias(t) for t, c in either.items()])
    norms = F.sqrt("xx") * F.sqrt("yy")
    score = F.when(norms != 0, F.col("xy") / norms).otherwise(0.0)
    sims = merged.select("item1", "item2", score.alias("score"), F.col("n").alias("num_pairs"))
    return sims if min_pairs <= 1 else sims.where(F.col("num_pairs") >= min_pairs)


def _sums(x: Column, y: Column) -> list[Column]:
    return [F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx"), F.sum(y * y).alias("yy"), F.count(x * y).alias("n")]


def _sum_lists(min_pairs: int, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow``: the sums of each pair with at least ``min_pairs`` pairs, from lists and partial sums sorted by ``item1``.

    It is nested as a whole, so that it is shipped by value.
    """
    sums = ["xy", "xx", "yy", "n"]

    def listed(rows: pa.RecordBatch, items: str, values: str) -> Iterator[pa.Table]:
        rows = rows.filter(pc.and_(rows[items].is_valid(), rows[values].is_valid()))
        if rows.num_rows:
            at = pc.list_parent_indices(rows[items])
            item1, x = rows["item1"].take(at), rows["value1"].take(at)
            item2 = pc.list_flatten(rows[items]).cast(item1.type)
            y = pc.list_flatten(rows[values]).cast(x.type)
            # A rating that meets a NULL counts for its own norm, as in pairs.
            xy = pc.multiply_checked(x, y)
            terms = [xy, pc.multiply_checked(x, x), pc.multiply_checked(y, y), xy.is_valid().cast(pa.int64())]
            yield pa.table([item1, item2, *terms], ["item1", "item2", *sums]).filter(pc.not_equal(item1, item2))

    def partial(rows: pa.RecordBatch) -> Iterator[pa.Table]:
        rows = rows.filter(rows["folded"].is_valid())
        if rows.num_rows:
            terms = [pc.struct_field(rows["folded"], t) for t in sums]
            yield pa.table([rows["item1"], pc.list_flatten(rows["far"]), *terms], ["item1", "item2", *sums])

    def summed(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts)
        kind = table["xy"].type
        # A product is no larger than the larger square.
        most = max(pc.max(table[t]).as_py() or 0 for t in ("xx", "yy")) if kind == pa.int64() else 0
        wide = most * table.num_rows >= 1 << 63
        if wide:
            for t in sums[:3]:
                table = table.set_column(table.schema.get_field_index(t), t, table[t].cast(pa.decimal128(38, 0)))
        table = table.group_by(["item1", "item2"], use_threads=False).aggregate([(t, "sum") for t in sums])
        table = table.select(["item1", "item2", *[f"{t}_sum" for t in sums]]).rename_columns(["item1", "item2", *sums])
        if wide:
            for t in sums[:3]:
                table = table.set_column(table.schema.get_field_index(t), t, table[t].cast(kind))
        return table

    def enough(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if min_pairs > 1:
            table = table.filter(pc.greater_equal(table["n"], min_pairs))
        return (b for b in table.to_batches(max_chunksize=1 << 16) if b.num_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, held = [], 0, 0
        for batch in batches:
            longest = pc.max(pc.coalesce(*[pc.list_value_length(batch[c]) for c in ("near", "far")])).as_py()
            step = max(1, chunk // (longest or 1))
            for start in range(0, batch.num_rows, step):
                rows = batch.slice(start, step)
                fresh = [t for i in ("near", "far") for v in ("low", "high") for t in listed(rows, i, v)]
                fresh += partial(rows)
                parts += fresh
                size += sum(t.num_rows for t in fresh)
                if size >= max(chunk, held):
                    table, last = summed(parts), rows["item1"][-1]
                    yield from enough(table.filter(pc.not_equal(table["item1"], last)))
                    rest = table.filter(pc.equal(table["item1"], last))
                    parts, size, held = [rest], 0, rest.num_rows
        if parts:
            yield from enough(summed(parts))

    return run


def _lists(rows: DataFrame, user: str) -> DataFrame:
    """For each rating of a user those of the user's larger items: ``item1``, ``value1``, and lists in narrow types if they fit."""
    kinds = dict(rows.dtypes)
    # A window sorts the ratings once; an aggregate into lists holds them twice and spills.
    larger = Window.partitionBy(user).orderBy("item", "value").rowsBetween(1, Window.unboundedFollowing)
    listed = rows.select(F.col("item").alias("item1"), F.col("value").alias("value1"), F.collect_list(F.struct("item", "value")).over(larger).alias("_all"))
    listed = listed.where(F.size("_all") > 0).select("item1", "value1", F.col("_all.item").alias("_items"), F.col("_all.value").alias("_values"))
    narrow = {"near": _narrowed("_items", kinds["item"], "int", 31), "low": _narrowed("_values", kinds["value"], "tinyint", 7)}
    listed = listed.withColumns(narrow)
    wide = {"far": F.when(F.col("near").isNull(), F.col("_items")), "high": F.when(F.col("low").isNull(), F.col("_values"))}
    return listed.withColumns(wide).select("item1", "value1", "near", "far", "low", "high")


def _narrowed(values: str, kind: str, narrow: str, bits: int) -> Column:
    """An array of whole numbers as one of a narrower type, NULL where one does not fit or ``kind`` is another."""
    if kind not in ("int", "bigint"):
        return F.lit(None).cast(f"array<{kind}>")
    fits = (F.array_min(values) >= -(1 << bits)) & (F.array_max(values) < 1 << bits)
    return F.when(F.coalesce(fits, F.lit(True)), F.col(values).cast(f"array<{narrow}>"))


def _unlisted(lists: DataFrame) -> DataFrame:
    """One row per entry of a list, but for further ratings of the same item: adds ``item2`` and ``value2``."""
    kind = dict(lists.dtypes)["value1"]
    each = lists.select("*", F.posexplode(F.coalesce("near", "far")).alias("_at", "item2"))
    value = F.coalesce(F.get("low", "_at").cast(kind), F.get("high", "_at"))
    return each.withColumn("value2", value).where(F.col("item1") < F.col("item2"))


def could_reach(rows: DataFrame, user: str, item: str, min_pairs: int, rounds: int = 1) -> DataFrame:
    """The ratings of items that may be in a pair with ``min_pairs`` pairs of ratings.

    A user who rated an item ``a`` times and no other item more than ``b`` times gives it at
    most ``a * b`` pairs with any one other item. Where the sum over an item's users is below
    ``min_pairs``, no pair of it can reach that. The items that go lower the bounds of others,
    hence the rounds. Each round is two aggregates of (user, item) counts.
    """
    counts = rows.where(F.col(user).isNotNull() & F.col(item).isNotNull()).groupBy(user, item).agg(F.count("*").alias("_times"))
    able = None
    for _ in range(rounds):
        left = counts if able is None else split_join(counts, able, item, "left_semi")
        # Of one user the two largest numbers of ratings of an item, found without bringing the user's rows together.
        most = left.groupBy(user).agg(
            F.max("_times").alias("_most"),
            F.max_by(F.col(item), F.struct("_times", item)).alias("_item"),
            F.sum("_times").alias("_all"),
            F.count("*").alias("_items"),
        )
        others = F.when(F.col(item) != F.col("_item"), F.col("_most")).otherwise(F.least("_most", F.col("_all") - F.col("_most")))
        reach = split_join(left, most, user).groupBy(item).agg(F.sum(F.col("_times") * others).alias("_reach"))
        able = reach.where(F.col("_reach") >= min_pairs).select(item)
    return split_join(rows, able, item, "left_semi")


def similarity_to_item(
    ratings: DataFrame, user: str, item: str, rating: str, target: int | str
) -> DataFrame:
    """The rows of ``item_similarity`` that involve one item, without the others.

    Joins the target's raters to their other ratings, which is linear in the
    number of ratings where the whole table is quadratic per user.
    """
    kind = _sum_type(ratings, rating)
    rows = ratings.select(
        F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast(kind).alias("r")
    )
    mine = rows.where(F.col("item") == target).select("user", F.col("r").alias("t"))
    common = rows.where(F.col("item") != target).join(mine, "user")
    is_first = F.col("item") < F.lit(target)
    sums = common.groupBy("item").agg(*_score(F.col("r"), F.col("t")))
    return sums.select(
        F.when(is_first, F.col("item")).otherwise(F.lit(target)).alias("item1"),
        F.when(is_first, F.lit(target)).otherwise(F.col("item")).alias("item2"),
        "score",
        "num_pairs",
    )


def similar_items(
    sims: DataFrame,
    target: int | str,
    min_score: float = 0.97,
    min_pairs: int = 50,
    k: int = 10,
    names: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` items most similar to ``target``: ``item``, ``score``, ``num_pairs``.

    Both thresholds are exclusive. ``names`` is an (item, name) table.
    """
    hits = sims.where(
        ((F.col("item1") == target) | (F.col("item2") == target))
        & (F.col("score") > min_score)
        & (F.col("num_pairs") > min_pairs)
    )
    other = F.when(F.col("item1") == target, F.col("item2")).otherwise(F.col("item1"))
    best = top_k(hits, [F.desc("score"), F.asc("item1"), F.asc("item2")], k).select(
        other.alias("item"), "score", "num_pairs"
    )
    return best if names is None else lookup(best, names.toDF("item", "name"), "item")


def average_rating(ratings: DataFrame, item: str, rating: str) -> DataFrame:
    """Mean rating per item, best first."""
    means = ratings.groupBy(item).agg(F.avg(rating).alias("avg_rating"))
    return means.orderBy(F.desc("avg_rating"), F.asc(item))


def _sum_type(ratings: DataFrame, rating: str) -> str:
    """Type in which products of ratings are summed: exact for whole numbers."""
    whole = dict(ratings.dtypes)[rating] in ("tinyint", "smallint", "int", "bigint")
    return "bigint" if whole else "double"
