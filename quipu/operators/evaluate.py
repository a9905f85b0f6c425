"""Leak-free offline evaluation: hold-out, sampled negatives, recall."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quipu.operators.indexing import dense_index, hash_number
from quipu.operators.joins import broadcast_if_small
from quipu.operators.recommend import Recommender
from quipu.operators.reshape import without_null_lists
from quipu.session import settle, task_count

TEST_PERCENT = 30  # fixed values: share held out, and the seed of the draw
SPLIT_SEED = 29
SLOT_ROWS = 200_000
GROUP_PAIRS = 50_000  # test pairs for which one task draws at a time
WALK_CELLS = 4_000_000  # steps of walks held at a time
BLOCK_POSITIONS = 1 << 22  # item positions that a task holds
MEETING_PAIRS = 1_000_000  # test pairs that meet one copy of a block of items


def holdout_split(
    pairs: DataFrame, percent: int = TEST_PERCENT, seed: int = SPLIT_SEED, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """Add ``is_test``: per user the first ``percent`` of the pairs in hash order.

    Users with very many pairs are cut into slots of the hash range.  Slot sizes
    tell how many test pairs fall in each, so no user is sorted as a whole.
    """
    sizes = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    large = settle(
        sizes.where(F.col("n") > slot_rows).select("user_id", F.ceil(F.col("n") / slot_rows).alias("slots")), "large"
    )
    number = hash_number(F.lit(seed), F.col("user_id"), F.col("item_id"))
    draw = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("user_id").cast("string"), F.col("item_id").cast("string")))
    placed = pairs.withColumn("draw", draw)
    if large.take(1):
        slots = F.coalesce("slots", F.lit(1))
        # Without the broadcast the rows of a user would stay together; the new placement parts them.
        placed = placed.join(broadcast_if_small(large), "user_id", "left").withColumn(
            "slot", F.shiftright(number * slots, 32)
        ).repartition("user_id", "slot")
    else:
        placed = placed.withColumn("slot", F.lit(0).cast("bigint"))
    per_slot = placed.groupBy("user_id", "slot").agg(F.count(F.lit(1)).alias("c"))
    of_user = Window.partitionBy("user_id")
    upto = of_user.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = F.floor((F.sum("c").over(of_user) * percent + 50) / 100)
    before = F.sum("c").over(upto) - F.col("c")
    quota = per_slot.select(
        "user_id", "slot", F.greatest(F.lit(0), F.least(F.col("c"), want - before)).alias("quota")
    )
    rank = F.row_number().over(Window.partitionBy("user_id", "slot").orderBy("draw", "item_id"))
    ranked = placed.withColumn("rank", rank)
    return ranked.join(quota, ["user_id", "slot"]).select(*pairs.columns, (F.col("rank") <= F.col("quota")).alias("is_test"))


def next_prime(n: int) -> int:
    """Smallest prime that is at least ``n`` (and at least 3)."""
    p = max(3, n | 1)
    while any(p % d == 0 for d in range(3, int(p**0.5) + 1, 2)):
        p += 2
    return p


def negative_samples(
    test: DataFrame, seen: DataFrame, items: DataFrame, n: int, seed: int = SPLIT_SEED, packed: bool = False
) -> DataFrame | Samples:
    """``n`` unseen items for every test pair: (user_id, item_id, negative, draw).

    Each pair walks the item positions from a hashed start by a hashed step,
    modulo a prime, so no item comes twice and all are reached in the end.  The
    first ``n`` unseen items of the walk are the sample (all of them, if the
    user has fewer left).  With ``packed`` the rows are not made, but can be had
    from the ``Samples`` returned.
    """
    positions = settle(dense_index(items.select("item_id").distinct(), "item_id", "pos"), "positions")
    total = positions.count()
    prime = next_prime(total)
    if prime >= 2**31:
        raise ValueError("positions of more than 2^31 items are not walked")
    key = [F.lit(seed), F.col("user_id"), F.col("item_id")]
    pairs = test.select("user_id", "item_id").distinct().withColumns(
        {"start": hash_number(*key) % prime, "step": hash_number(*key, start=9) % (prime - 1) + 1}
    )
    samples = Samples(settle(pairs, "test-pairs"), seen, positions, total, prime, n)
    return samples if packed else samples.rows()


class Samples:
    """Unseen items drawn for test pairs, kept as lists of item positions.

    Users are dealt into groups; a task draws for all pairs of a group from the positions
    its users have seen.  Users with very many pairs are spread over several groups, each
    with all that they have seen, which is no more than the catalogue.
    """

    def __init__(self, pairs: DataFrame, seen: DataFrame, positions: DataFrame, total: int, prime: int, n: int):
        self.pairs, self.seen, self.positions, self.total, self.prime, self.n = pairs, seen, positions, total, prime, n
        self.size = pairs.count()
        self._rows: DataFrame | None = None

    def lists(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``block``, ``pos`` and ``draw``: a row per block of positions that holds drawn ones."""
        spark = pairs.sparkSession
        groups = max(-(-self.size // GROUP_PAIRS), min(2 * task_count(spark), self.size // 1000), 1)
        sizes = self.pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        large = settle(
            sizes.where(F.col("n") > GROUP_PAIRS).select("user_id", F.ceil(F.col("n") / GROUP_PAIRS).alias("slots")), "large"
        )
        gone = self.seen.select(F.col("user_id").cast(pairs.schema["user_id"].dataType), "item_id").where("user_id IS NOT NULL")
        gone = gone.join(self.positions, "item_id").select("user_id", "pos")
        if large.take(1):
            slots = F.coalesce("slots", F.lit(1))
            pairs = pairs.join(broadcast_if_small(large), "user_id", "left").withColumn("slot", F.pmod(F.xxhash64("item_id"), slots))
            gone = gone.join(broadcast_if_small(large), "user_id", "left").withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1)))
            pairs, gone = pairs.drop("slots"), gone.drop("slots")
        group, slot = F.pmod(F.xxhash64("user_id"), F.lit(groups)).alias("group"), F.lit(0)
        placed = [d.select("*", group, *([] if "slot" in d.columns else [slot.alias("slot")])) for d in (pairs, gone)]
        placed = [d.withColumn("slot", F.col("slot").cast("bigint")).repartition(min(20_000, groups), "group", "slot") for d in placed]
        kept = [c for c in pairs.columns if c not in ("start", "step", "slot")]
        shape = ", ".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in kept)
        of_draw = "smallint" if self.n < 2**15 else "int"
        run = _drawing(kept, self.total, self.prime, self.n, of_draw)
        left, right = (d.groupBy("group", "slot") for d in placed)
        return left.cogroup(right).applyInArrow(run, f"{shape}, block int, pos array<int>, draw array<{of_draw}>")

    def meet_items(self, lists: DataFrame, items: DataFrame, kernel: Callable, schema: str) -> DataFrame:
        """Run ``kernel`` over the rows of ``lists`` with the ``items`` of their block, in order of position.

        ``items`` has ``pos`` and other columns.  A block is sent once per ``MEETING_PAIRS`` rows;
        a task holds one block and streams the lists past it.
        """
        spark = lists.sparkSession
        blocks = max(1, -(-self.total // BLOCK_POSITIONS))
        copies = max(-(-self.size // MEETING_PAIRS), min(2 * spark.sparkContext.defaultParallelism, -(-self.size // 10_000)), 1)
        rest = [c for c in items.columns if c != "pos"]
        right = items.select(
            F.floor(F.col("pos") / BLOCK_POSITIONS).cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))).alias("copy"),
            F.lit(0).alias("kind"),
            F.col("pos").alias("at"),
            *[F.col(c).alias(f"of_{c}") for c in rest],
        )
        left = lists.withColumns({"copy": F.pmod(F.xxhash64("user_id", "item_id"), F.lit(copies)), "kind": F.lit(1)})
        both = without_null_lists(right.unionByName(left, allowMissingColumns=True), [c for c in ("pos", "draw") if c in lists.columns])
        both = both.repartition(blocks * copies, "block", "copy")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held, block = None, [], None
            for batch in batches:
                marks = [batch.column(c).to_numpy() for c in ("block", "copy", "kind")]
                change = np.flatnonzero(np.any([np.diff(m) != 0 for m in marks], axis=0)) + 1
                for first, last in zip([0, *change], [*change, batch.num_rows]):
                    part = batch.slice(first, last - first)
                    key = marks[0][first:first + 1].tolist() + marks[1][first:first + 1].tolist()
                    if key != now:
                        now, held, block = key, [], None
                    if not part.num_rows:
                        continue
                    if marks[2][first] == 0:
                        held.append(part.select(["at", *[f"of_{c}" for c in rest]]))
                    else:
                        block = pa.Table.from_batches(held).sort_by("at").combine_chunks() if block is None else block
                        yield from kernel(part, block, now[0] * BLOCK_POSITIONS).to_batches()

        return both.sortWithinPartitions("block", "copy", "kind").mapInArrow(run, schema)

    def rows(self) -> DataFrame:
        """(user_id, item_id, negative, draw)."""
        lists = self.lists(self.pairs)
        kinds = {"user_id": lists, "item_id": lists, "negative": self.positions.withColumnRenamed("item_id", "negative")}
        shape = ", ".join(f"{c} {d.schema[c].dataType.simpleString()}" for c, d in kinds.items())

        def kernel(part: pa.RecordBatch, block: pa.Table, base: int) -> pa.Table:
            owner, at = pc.list_parent_indices(part["pos"]), pc.list_flatten(part["pos"])
            negative = block["of_item_id"].take(pc.subtract(at, pa.scalar(base, pa.int32()))).combine_chunks()
            columns = [part["user_id"].take(owner), part["item_id"].take(owner), negative, pc.list_flatten(part["draw"]).cast(pa.int64())]
            return pa.table(columns, names=["user_id", "item_id", "negative", "draw"])

        return self.meet_items(lists, self.positions, kernel, f"{shape}, draw bigint")

    def written(self) -> DataFrame:
        """The rows, made once and read again where several models are judged by them."""
        self._rows = self._rows or settle(self.rows(), "negatives")
        return self._rows

    def ranks(self, scores: DataFrame) -> DataFrame:
        """(user_id, item_id, rank) of the test items by ``scores`` that are the same for all users; null without a score."""
        scores = scores.select("item_id", F.round("score", 9).cast("double").alias("own"))
        known = settle(self.pairs.join(scores, "item_id", "left").select("user_id", "item_id", "start", "step", "own"), "own")
        items = self.positions.join(scores, "item_id", "left")
        lists = self.lists(known.where("own IS NOT NULL"))
        shape = ", ".join(f"{c} {lists.schema[c].dataType.simpleString()}" for c in ("user_id", "item_id", "own"))

        def kernel(part: pa.RecordBatch, block: pa.Table, base: int) -> pa.Table:
            owner = pc.list_parent_indices(part["pos"]).to_numpy()
            at = pc.list_flatten(part["pos"]).to_numpy() - base
            score = block["of_own"].to_numpy()[at]  # missing ones become NaN, which is neither above nor level
            own = part["own"].to_numpy()[owner]
            ahead = score > own
            level = np.flatnonzero(score == own)
            smaller = pc.less(block["of_item_id"].take(pa.array(at[level])), part["item_id"].take(pa.array(owner[level])))
            ahead[level] = pc.fill_null(smaller, False).to_numpy()
            counts = pa.array(np.bincount(owner[ahead], minlength=part.num_rows), pa.int64())
            return pa.table([part["user_id"], part["item_id"], part["own"], counts], names=["user_id", "item_id", "own", "ahead"])

        counted = self.meet_items(lists.drop("draw"), items, kernel, f"{shape}, ahead bigint")
        every = counted.unionByName(known.select("user_id", "item_id", "own", F.lit(0).cast("bigint").alias("ahead")))
        sums = every.groupBy("user_id", "item_id").agg(F.max("own").alias("own"), F.sum("ahead").alias("ahead"))
        return sums.select("user_id", "item_id", F.when(F.col("own").isNotNull(), (F.col("ahead") + 1).cast("int")).alias("rank"))


def _drawing(kept: list[str], total: int, prime: int, n: int, of_draw: str) -> Callable:
    """The draws of one group: test pairs on the left, positions that their users have seen on the right."""
    small = pa.int16() if of_draw == "smallint" else pa.int32()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        users = pa.concat_arrays([t["user_id"].combine_chunks() for t in (left, right)]).dictionary_encode()
        own = users.indices.fill_null(len(users.dictionary)).to_numpy().astype(np.int64)
        own, theirs = own[: len(left)], own[len(left) :]
        start, step = left["start"].to_numpy(), left["step"].to_numpy()
        seen = np.unique(theirs * prime + right["pos"].to_numpy())
        spare = total - np.bincount(seen // prime, minlength=len(users.dictionary) + 1)[own]
        need = np.minimum(n, spare)
        # Expected steps to meet that many unseen items, plus four deviations.
        reach = (need + 4 * np.sqrt(need * (1 - spare / prime))) * prime / np.maximum(spare, 1) + 3
        reach = np.minimum(prime, np.ceil(reach)).astype(np.int64)
        few = (spare <= 4 * n) | (spare <= reach)
        found = [_walked(np.flatnonzero((need > 0) & ~few), reach, own, start, step, need, seen, total, prime)]
        found += _from_rest(np.flatnonzero((need > 0) & few), own, start, step, need, seen, total, prime)
        row, pos, draw = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((draw, pos // BLOCK_POSITIONS, row))
        row, pos, draw = row[order], pos[order], draw[order]
        block = pos // BLOCK_POSITIONS
        first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        ends = pa.array(np.append(first, len(row)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, k)) for x, k in ((pos, pa.int32()), (draw, small))]
        columns = [left[c].take(pa.array(row[first])) for c in kept]
        return pa.table([*columns, pa.array(block[first], pa.int32()), *lists], names=[*kept, "block", "pos", "draw"])

    return run


def _walked(todo, reach, own, start, step, need, seen, total, prime) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, positions and numbers of the draws by walking; walks that come up short are walked again twice as far."""
    out, width = [[np.zeros(0, np.int64)] for _ in range(3)], reach[todo]
    while len(todo):
        order = np.argsort(width, kind="stable")
        todo, width, short, at = todo[order], width[order], [], 0
        while at < len(todo):
            cells = width[at:] * np.arange(1, len(todo) - at + 1)
            upto = at + max(1, int(np.searchsorted(cells, WALK_CELLS, side="right")))
            some, steps = todo[at:upto], int(width[upto - 1])
            where = (start[some, None] + np.arange(steps) * step[some, None]) % prime
            code = own[some, None] * prime + where
            known = np.minimum(np.searchsorted(seen, code), max(len(seen) - 1, 0))
            fresh = where < total
            if len(seen):
                fresh &= seen[known] != code
            number = np.cumsum(fresh, axis=1)
            enough = number[:, -1] >= need[some]
            r, c = np.nonzero(fresh & (number <= need[some, None]) & enough[:, None])
            for kept, x in zip(out, (some[r], where[r, c], number[r, c])):
                kept.append(x)
            short.append((some[~enough], np.full((~enough).sum(), min(prime, 2 * steps))))
            at = upto
        todo, width = (np.concatenate(x) for x in zip(*short))
    return tuple(np.concatenate(x) for x in out)


def _from_rest(todo, own, start, step, need, seen, total, prime) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The draws of users with few unseen items: these are listed and sorted by their place in the walk."""
    out = []
    todo = todo[np.argsort(own[todo], kind="stable")]
    for of_user in np.split(todo, np.flatnonzero(np.diff(own[todo])) + 1):
        if not len(of_user):
            continue
        low, high = np.searchsorted(seen, [own[of_user[0]] * prime, (own[of_user[0]] + 1) * prime])
        unseen = np.ones(total, bool)
        unseen[seen[low:high] % prime] = False
        rest, take = np.flatnonzero(unseen), int(need[of_user[0]])
        height = max(1, WALK_CELLS // len(rest))
        for some in (of_user[x : x + height] for x in range(0, len(of_user), height)):
            back = np.array([pow(int(x), -1, prime) for x in step[some]], np.int64)
            place = (rest - start[some, None]) % prime * back[:, None] % prime
            chosen = rest[np.argsort(place, axis=1)[:, :take]]
            out.append((np.repeat(some, take), chosen.ravel(), np.tile(np.arange(1, take + 1), len(some))))
    return out


def hits(test: DataFrame, negatives: DataFrame | Samples, model: Recommender, at: Sequence[int] = (5, 10)) -> DataFrame:
    """Rank of every test item among itself and its negatives, and whether it is within the first k.

    Scores are compared at nine decimals and ties go to the smaller item.  An
    item the model cannot score is not found, as rank null and no hit.  A model whose
    scores are the same for all users (``item_scores``) ranks packed samples as they are.
    """
    if isinstance(negatives, Samples):
        if (scores := getattr(model, "item_scores", None)) is not None:
            return _with_hits(negatives.ranks(scores()), at)
        negatives = negatives.written()
    positive = test.select("user_id", "item_id", F.col("item_id").alias("candidate"))
    rest = negatives.select("user_id", "item_id", F.col("negative").alias("candidate"))
    wanted = positive.unionByName(rest).select(
        "user_id", F.col("item_id").alias("target"), F.col("candidate").alias("item_id")
    )
    scored = model.score(wanted).withColumn("score", F.round("score", 9))
    own = F.max(F.when(F.col("item_id") == F.col("target"), F.col("score"))).alias("own")
    # At most one test item and its sample: a bounded list.
    others = F.collect_list(
        F.when(F.col("item_id") != F.col("target"), F.struct(F.col("score").alias("s"), F.col("item_id").alias("i")))
    ).alias("others")
    grouped = scored.groupBy("user_id", F.col("target").alias("item_id")).agg(own, others)
    ahead = F.filter(
        "others", lambda o: (o["s"] > F.col("own")) | ((o["s"] == F.col("own")) & (o["i"] < F.col("item_id")))
    )
    ranked = grouped.select("user_id", "item_id", F.when(F.col("own").isNotNull(), F.size(ahead) + 1).alias("rank"))
    return _with_hits(ranked, at)


def _with_hits(ranked: DataFrame, at: Sequence[int]) -> DataFrame:
    return ranked.select(
        "*", *[F.coalesce((F.col("rank") <= k).cast("int"), F.lit(0)).alias(f"hit_{k}") for k in at]
    )


def recall_per_user(found: DataFrame, at: Sequence[int] = (5, 10)) -> DataFrame:
    sums = found.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_test"), *[F.sum(f"hit_{k}").alias(f"hits_{k}") for k in at]
    )
    return sums.select("*", *[(F.col(f"hits_{k}") / F.col("n_test")).alias(f"recall_{k}") for k in at])


def recall_global(found: DataFrame, name: str, at: Sequence[int] = (5, 10)) -> DataFrame:
    sums = found.agg(F.count(F.lit(1)).alias("n_test"), *[F.sum(f"hit_{k}").alias(f"hits_{k}") for k in at])
    return sums.select(
        F.lit(name).alias("model"), "n_test",
        *[F.try_divide(f"hits_{k}", "n_test").alias(f"recall_{k}") for k in at],
    )


def compare(
    models: Sequence[Recommender],
    ratings: DataFrame,
    catalog: DataFrame,
    n_negatives: int,
    fit_on: str = "train",
    at: Sequence[int] = (5, 10),
) -> DataFrame:
    """One row per model.  ``fit_on="all"`` repeats the leak of fitting on the held-out pairs too."""
    split = settle(holdout_split(ratings), "split")
    test = split.where("is_test")
    fitted_on = split if fit_on == "all" else split.where("NOT is_test")
    negatives = negative_samples(test, split, catalog, n_negatives, packed=True)
    rows = None
    for model in models:
        found = hits(test, negatives, model.fit(fitted_on, catalog), at)
        row = recall_global(found, model.name, at)
        rows = row if rows is None else rows.unionByName(row)
    return rows


def rmse(actual: DataFrame, predicted: DataFrame, value: str = "score") -> DataFrame:
    """Root mean squared error over the pairs present on both sides."""
    both = actual.select("user_id", "item_id", F.col(value).alias("a")).join(
        predicted.select("user_id", "item_id", F.col("score").alias("p")), ["user_id", "item_id"]
    )
    return both.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.pow(F.col("a") - F.col("p"), 2))).alias("rmse"))
