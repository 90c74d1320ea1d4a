"""Splits that keep related records together.

Kept from batch to batch, in the shared folder:

* ``labels``: every node (a record id, a parent id, a speaker) with its home, the root its component had when the node came. Bucketed by
  node and only appended to, so a batch reads the buckets of its own nodes;
* ``moves``: homes that have been merged since, with their present root; far fewer than nodes, rewritten only by a batch that merges;
* ``records``: record ids with their node, bucketed, appended to;
* ``parts``: size, split and quarantine of each root; only the buckets of touched roots are rewritten.

A batch of ties is first mapped to present roots, so only the contracted graph is worked on: every root hooks to its smallest neighbour,
pointer jumping flattens the hooks, edges are contracted, until none is left. A speaker of a third of all records is one
hub: its edges are reduced to minima map-side and vanish in the first round; joins on it are split by AQE.

Existing components keep their split. New ones fill the deficits of the shares: components above a thousandth of all
records (at most a thousand exist) largest first, the others in a fixed number of hash buckets, each to the split
that lacks most. When a batch ties components of different splits together, the merge is quarantined: the largest keeps its split and takes
the new records; the others keep theirs, but their records are marked quarantined and should stay out of use until someone decides. So records
that aren't quarantined are together with all their relatives that aren't, and none ever changes its split. ``conflicts`` lists these merges.

Cases: null or blank ids tie nothing; a record that names itself as parent is tied to nobody by that; repeated rows
change nothing; a record without ties is a component of its own; an empty batch changes nothing; records with null
id are ignored; other columns are ignored. All rows of a record must give the same node. Ids compare without regard to case, width and surrounding blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import compare_form
from ..plans.staging import Stage
from .buckets import BucketedTable

SHARES = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
BUCKETS = 4096


def node(kind: str, value: Column) -> Column:
    """Node of an id, null where the id is null or blank."""
    form = compare_form(value)
    return F.when(form != "", F.concat(F.lit(kind + ":"), form))


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't its component's smallest node."""
    left, n = stage.write_counted(_ordered(edges), "edges")
    total: DataFrame | None = None
    while n:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stage.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).where("root < node"), "hooks")
        moved = 1
        while moved:  # pointer jumping, two jumps for each table written
            once = _jump(hooks).select("node", F.coalesce("further", "root").alias("root"))
            jumped, moved = stage.write_counted(_jump(once), "jumps", F.col("further").isNotNull())
            hooks = jumped.select("node", F.coalesce("further", "root").alias("root"))
        ends = left
        for end in ("a", "b"):
            ends = ends.join(hooks.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left").withColumn(end, F.coalesce(f"{end}_root", end)).drop(f"{end}_root")
        left, n = stage.write_counted(_ordered(ends), "edges")
        if total is None:
            total = hooks
        else:
            later = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
            total = total.join(later, "root", "left").select("node", F.coalesce("further", "root").alias("root")).unionByName(hooks)
            total = stage.write(total, "total") if n else total
    return total if total is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _jump(hooks: DataFrame) -> DataFrame:
    return hooks.join(hooks.select(F.col("node").alias("root"), F.col("root").alias("further")), "root", "left")


class ComponentTable:
    """Components and their splits, kept from batch to batch."""

    def __init__(self, spark: SparkSession, stage: Stage, shares: tuple[tuple[str, float], ...] = SHARES, buckets: int | None = None):
        self.spark, self.stage, self.shares, self.batches = spark, stage, shares, 0
        self._labels = BucketedTable(stage, "node string, home string", ("node",), buckets)
        self._records = BucketedTable(stage, "record_id string, node string, batch int", ("record_id",), buckets)
        self._parts = BucketedTable(stage, "root string, n_records bigint, split string, quarantined boolean", ("root",), buckets)
        self._moves: DataFrame | None = None  # home, root, part: homes that aren't their own root and part
        self._conflicts: list[DataFrame] = []
        self._have = dict.fromkeys([s for s, _ in shares], 0)

    def _touched(self, table: BucketedTable, rows: DataFrame, n: int) -> DataFrame:
        """The buckets of ``table`` that ``rows`` may meet; so many rows meet all."""
        return table.matching(table.parts_of(rows) if n < 20 * table.buckets else range(table.buckets))

    def add(self, ties: DataFrame) -> None:
        """A batch of (record_id, node, other): ``other`` is a node the record is tied to, or null."""
        ties, n = self.stage.write_counted(ties.where("record_id is not null and node is not null").select("record_id", "node", "other").distinct(), "ties")
        if not n:
            return
        self.batches += 1
        nodes = ties.select(F.explode(F.array("node", "other")).alias("node")).where("node is not null").distinct()
        met = nodes.join(self._touched(self._labels, nodes, n), "node", "left")
        if self._moves is not None:
            met = met.join(self._moves.select("home", "root"), "home", "left")
        else:
            met = met.withColumn("root", F.lit(None).cast("string"))
        met = self.stage.write(met.select("node", F.col("home").isNull().alias("fresh"), F.coalesce("root", "home", "node").alias("root")), "met")
        edges = ties.where("other is not null")
        for end, name in (("a", "node"), ("b", "other")):
            edges = edges.join(met.select(F.col("node").alias(name), F.col("root").alias(end)), name)
        merged = components(edges.select("a", "b"), self.stage).select(F.col("node").alias("root"), F.col("root").alias("low"))
        self._keep_records(ties, n)
        fresh = self._records.all().where(F.col("batch") == self.batches).join(met, "node").groupBy("root").agg(F.count("*").alias("n_new"))
        roots = met.groupBy("root").agg(F.min("fresh").alias("fresh")).join(merged, "root", "left").withColumn("low", F.coalesce("low", "root")).join(fresh, "root", "left")
        known = self._touched(self._parts, met.where("not fresh").select("root").distinct(), n)
        roots = self.stage.write(roots.join(known.select("root", "n_records", "split"), "root", "left"), "roots")
        best = F.max(F.when(~F.col("fresh"), F.struct("n_records", "root", "split"))).alias("best")
        groups = roots.groupBy("low").agg(best, F.coalesce(F.sum("n_new"), F.lit(0)).alias("n_new"))
        groups = groups.select("low", F.coalesce("best.root", "low").alias("winner"), F.col("best.split").alias("kept"), "n_new")
        seen = Observation()
        groups = self.stage.write(groups.observe(seen, F.sum("n_new").alias("n")), "groups")
        groups = self._with_split(groups, seen.get["n"] or 0)
        owners = roots.join(groups.select("low", "winner", F.col("split").alias("to_split")), "low")
        lost = F.col("split").isNotNull() & (F.col("split") != F.col("to_split"))
        owners = self.stage.write(owners.select("root", "winner", "fresh", "n_records", "split", "to_split", lost.alias("lost")), "owners")
        self._labels.append(met.where("fresh").join(owners.select("root", "winner"), "root").select("node", F.col("winner").alias("home")))
        self._update_parts(owners, groups, n)
        self._move(owners)

    def _keep_records(self, ties: DataFrame, n: int) -> None:
        rows = ties.groupBy("record_id").agg(F.min("node").alias("node")).withColumn("batch", F.lit(self.batches))
        known = not self._records.empty
        if known:
            rows = rows.join(self._touched(self._records, ties.select("record_id"), n).select("record_id"), "record_id", "left_anti")
        self._records.append(rows, placed=known)

    def _with_split(self, groups: DataFrame, n_new: int) -> DataFrame:
        """(low, winner, split, n_new): split of every touched component; those without one fill the deficits."""
        bucket = F.pmod(F.xxhash64("low"), F.lit(BUCKETS)).cast("int")
        total = sum(self._have.values()) + n_new
        great = F.col("kept").isNull() & (F.col("n_new") * 1000 > total)
        small = F.col("kept").isNull() & ~great
        # At most 1,000 components above a thousandth, BUCKETS sums and one for each split come to the driver.
        keys = [F.col("kept"), F.when(great, F.col("low")).alias("root"), F.when(small, bucket).alias("bucket")]
        open_ = []
        for r in groups.groupBy(*keys).agg(F.sum("n_new").alias("n")).collect():
            if r["kept"] is None:
                open_.append(r)
            else:
                self._have[r["kept"]] += r["n"]
        lacks = {s: share * total - self._have[s] for s, share in self.shares}
        chosen: list[tuple] = []
        for r in sorted(open_, key=lambda r: (r["root"] is None, -r["n"], r["root"] or "", r["bucket"] or 0)):
            to = max(lacks, key=lambda s: (lacks[s], s))
            lacks[to] -= r["n"]
            self._have[to] += r["n"]
            chosen.append((r["root"], r["bucket"], to))
        by_root = self.spark.createDataFrame([(a, c) for a, _, c in chosen if a is not None], "low string, by_root string")
        by_bucket = self.spark.createDataFrame([(b, c) for a, b, c in chosen if a is None], "bucket int, by_bucket string")
        done = groups.withColumn("bucket", bucket).join(F.broadcast(by_root), "low", "left").join(F.broadcast(by_bucket), "bucket", "left")
        return done.select("low", "winner", F.coalesce("kept", "by_root", "by_bucket").alias("split"), "n_new")

    def _update_parts(self, owners: DataFrame, groups: DataFrame, n: int) -> None:
        lost = owners.where("lost").select("root", F.col("n_records").alias("n"), "split", F.lit(True).alias("aside"))
        added = owners.where("not fresh and not lost").groupBy("winner").agg(F.sum("n_records").alias("n_old"))
        won = groups.join(added, "winner", "left").select(F.col("winner").alias("root"), (F.col("n_new") + F.coalesce("n_old", F.lit(0))).alias("n"), "split", F.lit(False).alias("aside"))
        update = won.unionByName(lost)
        if self._parts.empty:
            self._parts.append(update.select("root", F.col("n").alias("n_records"), "split", F.col("aside").alias("quarantined")))
            return
        update = update.withColumnRenamed("split", "to_split")
        known = self._touched(self._parts, update, n).join(update, "root", "full_outer")
        self._parts.replace(known.select("root", F.coalesce("n", "n_records").alias("n_records"), F.coalesce("to_split", "split").alias("split"), F.coalesce("aside", "quarantined").alias("quarantined")), placed=True)

    def _move(self, owners: DataFrame) -> None:
        """Old roots that aren't the winner of their component follow it; their part does too, unless it is set aside."""
        gone, n = self.stage.write_counted(owners.where("not fresh and root <> winner").drop("fresh"), "gone")
        if not n:
            return
        aside = gone.where("lost")
        self._conflicts.append(aside.select(F.lit(self.batches).alias("batch"), F.col("winner").alias("kept_root"), F.col("root").alias("aside_root"), F.col("to_split").alias("kept_split"), F.col("split").alias("aside_split"), F.col("n_records").alias("n_aside")))
        for r in aside.groupBy("split").agg(F.sum("n_records").alias("n")).collect():  # one row for each split
            self._have[r["split"]] -= r["n"]
        new = gone.select(F.col("root").alias("home"), F.col("winner").alias("root"), F.when(F.col("lost"), F.col("root")).otherwise(F.col("winner")).alias("part"))
        if self._moves is not None:
            step = gone.select("root", "winner", "lost")
            moved = self._moves.join(step, "root", "left")
            part = F.when((F.col("part") == F.col("root")) & ~F.coalesce("lost", F.lit(True)), F.col("winner")).otherwise(F.col("part"))
            new = moved.select("home", F.coalesce("winner", "root").alias("root"), part.alias("part")).unionByName(new)
        self._moves = self.stage.write(new, "moves")

    def _members(self) -> DataFrame:
        """(record_id, root, part)."""
        at_home = self._records.unbucketed().join(self._labels.unbucketed(), "node")
        if self._moves is None:
            return at_home.select("record_id", F.col("home").alias("root"), F.col("home").alias("part"))
        return at_home.join(self._moves, "home", "left").select("record_id", F.coalesce("root", "home").alias("root"), F.coalesce("part", "home").alias("part"))

    def assigned(self) -> DataFrame:
        """(record_id, split, quarantined, root)."""
        parts = self._parts.unbucketed().select(F.col("root").alias("part"), "split", "quarantined")
        return self._members().join(parts, "part").select("record_id", "split", "quarantined", "root")

    def conflicts(self) -> DataFrame:
        """(batch, kept_root, aside_root, kept_split, aside_split, n_aside): merges in quarantine."""
        out = self.spark.createDataFrame([], "batch int, kept_root string, aside_root string, kept_split string, aside_split string, n_aside bigint")
        for part in self._conflicts:
            out = out.unionByName(part)
        return out

    def related(self) -> DataFrame:
        """(first_id, record_id): each record of a component but the one with the smallest id."""
        members = self.stage.write(self._members().select("record_id", "root"), "members")
        first = members.groupBy("root").agg(F.min("record_id").alias("first_id"), F.max("record_id").alias("last_id")).where("first_id <> last_id")
        return members.join(first.drop("last_id"), "root").where("record_id <> first_id").select("first_id", "record_id")
