"""Mixing sources to target shares by pivotal dependent rounding.

Every document of a source is to be taken the same number of times on average,
say 1.7. The whole part is sure; the rest is rounded so that the words of the
source come out near its target: two documents with open fractions meet, and
words of expectation are moved from one to the other, at random but fair, until
one of them is settled at 0 or 1. The other goes on to the next.

Large documents come first. The documents of a source fall into bands of like
size. Within a band groups of documents meet side by side, what each leaves open
meets in the next round, and so on, as a tree, until one document is left. That
one meets all smaller documents of the source at once: it is settled by its own
fraction, and the words gained or owed are spread over them. So a source ends
within about one of its smallest documents, and every document is taken as often
as it should be on average. Only where the smaller ones together cannot take up
a document's words does it go to the nearer end: near comes before fair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termspace.llm.common import WORD, columns_as, fresh_name
from termspace.operators.vocabulary import dense_index
from termspace.session import scratch_path, settle

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 42
# Documents that meet in one group of a round.
FAN = 64
# Sizes of a band differ by less than this factor.
BAND = 4
_TINY = 1e-9

_OPEN = "struct<order: bigint, hash: bigint, id: {id}, size: bigint, rows: bigint, mass: double>"
_DONE = "array<struct<id: {id}, size: bigint, rows: bigint, bit: int>>"


def words_in(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int, work: str) -> DataFrame:
    """(_source, _idx, _words, _items, _target) from (_source, _words, _items).

    Sources in order of code point, null last, weigh ``weights`` in turn. They
    share all words by weight; no target passes ``most`` times the source's own
    words, and the excess is shared among the others until none is above.
    """
    order = [F.col("_source").asc_nulls_last()]
    ranked = dense_index(sizes, order, "_idx", f"{work}/order")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_idx") % len(weights)).cast("int"))
    ranked = settle(ranked.withColumn("_weight", weight), "sources", work)
    cap = F.col("_words") * most
    # Words per unit of weight: rises as sources reach their caps, each step one sum over the sources.
    level = None
    while True:
        capped = F.lit(False) if level is None else cap < F.col("_weight") * level
        row = ranked.agg(
            F.sum("_words").alias("all"),
            F.sum(F.when(capped, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("_weight"))).alias("free"),
        ).first()
        following = (row["all"] - row["capped"]) / row["free"] if row["free"] else level or 0.0
        if following == level:
            break
        level = following
    target = F.least(F.col("_weight") * F.lit(level), cap.cast("double"))
    return ranked.select("_source", "_idx", "_words", "_items", target.alias("_target"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _uniform(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(2**53)).cast("double") / float(2**53)


def _pivot(id_type: str, seed: int) -> Callable[[Column, Column], Column]:
    """One meeting: the open document of the state and the next one."""
    open_type, done_type = _OPEN.format(id=id_type), _DONE.format(id=id_type)

    def settled(item: Column, bit: Column) -> Column:
        return F.struct(item["id"].alias("id"), item["size"].alias("size"), item["rows"].alias("rows"), bit.alias("bit"))

    def with_mass(item: Column, mass: Column) -> Column:
        fields = [item[f].alias(f) for f in ("order", "hash", "id", "size", "rows")]
        return F.struct(*fields, mass.alias("mass"))

    def state(open_: Column, done: Column) -> Column:
        return F.struct(open_.cast(open_type).alias("open"), done.cast(done_type).alias("done"))

    def meet(acc: Column, x: Column) -> Column:
        a = acc["open"]
        weight_a, weight_x = a["size"] * a["rows"], x["size"] * x["rows"]
        up = F.least(weight_a - a["mass"], x["mass"])
        down = F.least(a["mass"], weight_x - x["mass"])
        rise = _uniform(a["hash"], x["hash"], F.lit(seed)) * (up + down) < down
        moved = F.struct(rise.alias("rise"), F.when(rise, up).otherwise(-down).alias("by"))

        def outcome(m: Column) -> Column:
            mass_a, mass_x = a["mass"] + m["by"], x["mass"] - m["by"]
            a_done = F.when(m["rise"], weight_a - a["mass"] <= x["mass"]).otherwise(a["mass"] <= weight_x - x["mass"])
            bit_a = F.when(m["rise"], 1).otherwise(0)
            # If a stays open, x has settled the other way.
            bit_x = 1 - bit_a
            x_done = (mass_x <= weight_x * _TINY) | (mass_x >= weight_x * (1 - _TINY))
            return (
                F.when(~a_done, state(with_mass(a, mass_a), F.concat(acc["done"], F.array(settled(x, bit_x)))))
                .when(
                    x_done,
                    state(
                        F.lit(None),
                        F.concat(
                            acc["done"],
                            F.array(settled(a, bit_a), settled(x, F.when(mass_x > weight_x / 2, 1).otherwise(0))),
                        ),
                    ),
                )
                .otherwise(state(with_mass(x, mass_x), F.concat(acc["done"], F.array(settled(a, bit_a)))))
            )

        return F.when(a.isNull(), state(x, acc["done"])).otherwise(_let(moved, outcome))

    return meet


def _meet_all(share: Column, weight: Column, rest: Column, chance: Column, rest_share: Column) -> tuple[Column, Column]:
    """(bit, new share of the rest): a document of ``weight`` words and fraction ``share`` meets all smaller ones.

    Those are ``rest`` words of the fraction ``rest_share`` each.
    """
    room_up = rest * rest_share >= weight * (1 - share) * (1 - _TINY)
    room_down = rest * (1 - rest_share) >= weight * share * (1 - _TINY)
    bit = F.when(room_up & room_down, chance < share).otherwise(share >= 0.5).cast("int")
    moved = rest_share - (bit - share) * weight / rest
    return bit, F.when(rest > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved))).otherwise(0.0)


def _one_by_one(id_type: str, seed: int) -> Callable[[Column, Column], Column]:
    """The next document of a band that is one group meets all documents after it."""
    done_type = _DONE.format(id=id_type)

    def step(acc: Column, x: Column) -> Column:
        weight = x["size"] * x["rows"]
        rest = acc["rest"] - weight
        bit, share = _meet_all(acc["share"], weight, rest, _uniform(x["hash"], F.lit(seed)), acc["share"])
        row = F.struct(x["id"].alias("id"), x["size"].alias("size"), x["rows"].alias("rows"), bit.alias("bit"))
        return F.struct(share.alias("share"), rest.alias("rest"), F.concat(acc["done"], F.array(row)).cast(done_type).alias("done"))

    return step


def _bands(started: DataFrame, work: str) -> DataFrame:
    """(_idx, _band, _turn, _count, _rest): the bands of every source, the one of the largest documents first.

    The largest documents are one band as long as they are one group. ``_rest``
    is the words of the bands after it. One row per source and power of ``BAND``.
    """
    each = started.filter("_open").groupBy("_idx", "_band").agg(F.count("*").alias("_n"), F.sum(F.col("_size") * F.col("_rows")).alias("_w"))
    falling = Window.partitionBy("_idx").orderBy(F.col("_band").desc())
    first = F.sum("_n").over(falling) <= FAN
    rank = F.row_number().over(falling)
    each = each.select("*", F.when(first, 0).otherwise(rank).alias("_rank"))
    after = Window.partitionBy("_idx").orderBy("_rank").rangeBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy("_idx", "_rank")
    each = each.select(
        "_idx",
        "_band",
        (F.dense_rank().over(Window.partitionBy("_idx").orderBy("_rank")) - 1).alias("_turn"),
        F.sum("_n").over(whole).alias("_count"),
        F.coalesce(F.sum("_w").over(after), F.lit(0)).cast("double").alias("_rest"),
    )
    return settle(each, "bands", work)


def mix_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    work: str | None = None,
) -> DataFrame:
    """(_id, _source, _size, _rows, _source_size, _target, _copies): how often each document is taken.

    One row per distinct (id, source, size); ``_rows`` rows of ``docs`` share it
    and are taken alike. The size is the number of words of the whole text, null
    as empty. A null source is a source. Documents without words are never
    settled by chance and take no part. An empty table gives an empty result.
    The same table and seed give the same copies, whatever the partitions. Ties
    in size are ordered by a hash of id and size. Other columns are not read.

    Text is read once, for its size; everything after is one narrow row per
    document. Rows of one band are spread over groups of about ``FAN`` by hash,
    so a source with most rows is as many groups; each round shuffles what the
    one before left open, a FAN-th of it. The bands follow each other, for all
    sources at once: as many turns as a source has powers of ``BAND`` in its
    sizes with more documents than a group.
    """
    work = work or scratch_path(docs.sparkSession, "mixing")
    rows = columns_as(docs, _id=doc_id, _text=text, _source=source)
    rows = rows.select("_id", "_source", words_in("_text").alias("_size"))
    items = settle(rows.groupBy("_source", "_id", "_size").agg(F.count("*").alias("_rows")), "items", work)
    weight = F.col("_size") * F.col("_rows")
    sizes = items.groupBy("_source").agg(F.sum(weight).alias("_words"), F.count("*").alias("_items"))
    targets = settle(source_targets(sizes, weights, most, work), "targets", work)

    per_row = F.when(F.col("_words") > 0, F.col("_target") / F.col("_words")).otherwise(0.0)
    sure = F.floor(per_row + _TINY)
    part = F.greatest(per_row - sure, F.lit(0.0))
    known = targets.select("_idx", F.col("_source").alias("_same"), part.alias("_part"))
    joined = items.join(known, items["_source"].eqNullSafe(known["_same"])).drop("_same", "_source")
    is_open = (F.col("_size") > 0) & (F.col("_part") > _TINY)
    band = F.floor(F.log(float(BAND), weight.cast("double")) + _TINY).cast("int")
    started = settle(joined.select("*", is_open.alias("_open"), F.when(is_open, band).alias("_band")), "started", work)

    bands = _bands(started, work)
    turns = bands.groupBy("_turn").agg(F.max("_count").alias("most")).orderBy("_turn").collect()
    id_type = items.schema["_id"].dataType.simpleString()
    spread = F.xxhash64("_id", "_size", F.lit(seed))
    # Large documents meet first.
    item = F.struct(
        (-weight).alias("order"),
        spread.alias("hash"),
        F.col("_id").alias("id"),
        F.col("_size").alias("size"),
        F.col("_rows").alias("rows"),
        (weight * F.col("_share")).alias("mass"),
    )
    opened = started.filter("_open").drop("_open").join(bands, ["_idx", "_band"])
    opened = opened.select("_idx", "_turn", "_count", "_rest", "_id", "_size", "_rows")
    # Sorted within tasks, so that a turn reads its own row groups only.
    opened = settle(opened.sortWithinPartitions("_turn"), "open", work)
    shares = targets.select("_idx", part.alias("_share"))
    settled = []
    for row in turns:
        given = opened.filter(F.col("_turn") == row["_turn"]).join(shares, "_idx")
        groups = F.ceil(F.col("_count") / FAN).cast("long").alias("_groups")
        left = given.select("_idx", "_rest", "_share", groups, item.alias("item"))
        done, shares = _round_band(left, -(-row["most"] // FAN), id_type, seed, f"{work}/turn{row['_turn']}")
        settled += done
    whole = started.filter("NOT _open").select("_idx", "_id", "_size", "_rows", F.lit(0).alias("_bit"))
    for part_done in settled:
        whole = whole.unionByName(part_done.toDF("_idx", "_id", "_size", "_rows", "_bit"))
    known = targets.select("_idx", "_source", F.col("_words").alias("_source_size"), "_target")
    share = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    copies = F.floor(share + _TINY).cast("int") + F.col("_bit")
    counted = whole.join(known, "_idx")
    return counted.select("_id", "_source", "_size", "_rows", "_source_size", "_target", copies.alias("_copies"))


def _round_band(left: DataFrame, most_groups: int, id_type: str, seed: int, work: str) -> tuple[list[DataFrame], DataFrame]:
    """(settled rows, shares of the documents after): one band of every source, from (_idx, _rest, _share, _groups, item)."""
    open_type, done_type = _OPEN.format(id=id_type), _DONE.format(id=id_type)
    keys = ["_idx", "_rest", "_share", "_groups"]
    nothing = F.array().cast(done_type).alias("done")
    settled, shares = [], []

    # A band of one group: its documents are settled one by one.
    small = left.filter("_groups = 1").groupBy(*keys).agg(F.sort_array(F.collect_list("item")).alias("items"))
    words = F.aggregate("items", F.lit(0).cast("long"), lambda n, x: n + x["size"] * x["rows"])
    start = F.struct(F.col("_share").alias("share"), (F.col("_rest") + words).alias("rest"), nothing)
    small = small.select("_idx", F.aggregate("items", start, _one_by_one(id_type, seed)).alias("state"))
    small = settle(small.select("_idx", "state.share", "state.done"), "small", work)
    settled.append(small.select("_idx", F.inline("done")))
    shares.append(small.select("_idx", F.col("share").alias("_share")))

    left, turn = left.filter("_groups > 1"), 0
    while most_groups > 1 or turn:
        group = F.pmod(F.xxhash64(F.col("item.hash"), F.lit(turn)), F.col("_groups"))
        # Sorted by all fields in turn, so the order is the same in every run.
        met = left.groupBy(*keys, group.alias("_group")).agg(F.sort_array(F.collect_list("item")).alias("items"))
        start = F.struct(F.lit(None).cast(open_type).alias("open"), nothing)
        met = met.select(*keys, F.aggregate("items", start, _pivot(id_type, seed)).alias("state"))
        met = settle(met.select(*keys, "state.open", "state.done"), f"round{turn}", work)
        settled.append(met.select("_idx", F.inline("done")))
        last = F.col("_groups") == 1
        weight = F.col("open.size") * F.col("open.rows")
        chance = _uniform(F.col("open.hash"), F.lit(seed), F.lit(turn))
        bit, share = _meet_all(F.col("open.mass") / weight, weight, F.col("_rest"), chance, F.col("_share"))
        final = met.filter(last & F.col("open").isNotNull())
        settled.append(final.select("_idx", "open.id", "open.size", "open.rows", bit.alias("bit")))
        # Where nothing stays open the documents after keep their share.
        shares.append(met.filter(last).select("_idx", F.when(F.col("open").isNull(), F.col("_share")).otherwise(share).alias("_share")))
        left = met.filter(~last & F.col("open").isNotNull()).select(
            "_idx", "_rest", "_share", F.ceil(F.col("_groups") / FAN).cast("long").alias("_groups"), F.col("open").alias("item")
        )
        if most_groups == 1:
            break
        most_groups, turn = -(-most_groups // FAN), turn + 1
    after = shares[0]
    for more in shares[1:]:
        after = after.unionByName(more)
    return settled, after


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", work: str | None = None, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it; cases as in ``mix_counts``."""
    work = work or scratch_path(docs.sparkSession, "mixing")
    counts = mix_counts(docs, doc_id, text, source, work=work, **settings).filter((F.col("_copies") > 0) & (F.col("_size") > 0))
    names = [fresh_name(docs, n) for n in ("_mix_id", "_mix_source", "_mix_size", "_mix_copies", "_mix_copy")]
    key, name, size, copies, copy = names
    taken = counts.select(F.col("_id").alias(key), F.col("_source").alias(name), F.col("_size").alias(size), F.col("_copies").alias(copies))
    taken = settle(taken, "taken", work)
    given = docs.withColumn(copy, words_in(text)).filter(F.col(copy) > 0)
    same = F.col(doc_id).eqNullSafe(F.col(key)) & F.col(source).eqNullSafe(F.col(name)) & (F.col(copy) == F.col(size))
    # Alike at every size: both sides are shuffled by what tells rows apart, which is spread evenly.
    repeated = given.join(taken.hint("merge"), same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.drop(*names)
