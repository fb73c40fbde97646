"""Parent/child links between features.

Closures run as repeated joins on the frontier.  Depth-first order is an Euler tour: every node is an
element that enters and one that leaves, each element points to the next, and pointer doubling ranks
them, so a chain of n nodes takes log n rounds and no row holds a path.  Every round is written to the
shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .ordered import climb, dealt, number_rows


def parent_edges(features: DataFrame, id_: str = "id", parents: str = "parent") -> DataFrame:
    """``child_id, parent_id`` from a list-valued parent column."""
    return features.select(F.col(id_).alias("child_id"), F.explode(parents).alias("parent_id")).distinct()


def with_parents(features: DataFrame, edges: DataFrame, id_: str = "id", parents: str = "parent") -> DataFrame:
    """The list-valued parent column rebuilt from links, sorted; features without a link get an empty list."""
    lists = edges.groupBy(F.col("child_id").alias(id_)).agg(F.array_sort(F.collect_set("parent_id")).alias("__p"))
    kind = features.schema[parents].dataType if parents in features.columns else lists.schema["__p"].dataType
    out = features.join(lists, id_, "left").withColumn(parents, F.coalesce(F.col("__p").cast(kind), F.array().cast(kind)))
    return out.drop("__p")


def dangling(edges: DataFrame, nodes: DataFrame, id_: str = "id") -> DataFrame:
    """References to a parent that does not exist."""
    known = nodes.select(F.col(id_).alias("parent_id")).distinct()
    return edges.join(known, "parent_id", "left_anti").select("child_id", "parent_id")


def resolve(edges: DataFrame, nodes: DataFrame, id_: str = "id", carry: list[str] | None = None) -> DataFrame:
    """Edges with the columns of the parent, whatever the file order."""
    parents = nodes.select(F.col(id_).alias("parent_id"), *[
        F.col(c).alias(f"parent_{c}") for c in (carry or [])])
    return edges.join(parents, "parent_id")


def closure(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """``ancestor_id, node_id, depth``: everything below each root, the root at depth 0.

    Shortest depth wins; cycles end because a pair is never visited twice.  A round writes its new
    pairs only; what was found before is read where it was written.
    """
    start = (
        edges.select(F.col("parent_id").alias("node_id")).union(edges.select("child_id")).distinct()
        if roots is None else roots.select(F.col(roots.columns[0]).alias("node_id")).distinct()
    )
    links = stored(edges.select(F.col("parent_id").alias("node_id"), F.col("child_id").alias("next_id")).distinct(), "links")
    frontier = stored(start.select(F.col("node_id").alias("ancestor_id"), "node_id", F.lit(0).alias("depth")), "closure")
    seen, depth = frontier, 0
    while True:
        depth += 1
        step = (
            frontier.join(links, "node_id")
            .select("ancestor_id", F.col("next_id").alias("node_id")).distinct()
            .join(seen.select("ancestor_id", "node_id"), ["ancestor_id", "node_id"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = stored(step, "closure")
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)


def descendants(edges: DataFrame, roots: DataFrame | None = None, **options) -> DataFrame:
    return closure(edges, roots, **options)


def ancestors(edges: DataFrame, roots: DataFrame | None = None, **options) -> DataFrame:
    """The same walk upwards: ``node_id, ancestor_id, depth``."""
    up = closure(_flipped(edges), roots, **options)
    return up.select(F.col("ancestor_id").alias("node_id"), F.col("node_id").alias("ancestor_id"), "depth")


def _flipped(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("parent_id").alias("child_id"), F.col("child_id").alias("parent_id"))


def _forest(choice: DataFrame) -> DataFrame:
    """``v, parent, root`` of nodes that hang on a root, by pointer doubling along ``v, parent``.

    After as many rounds as the node count has bits, only cycles and what hangs on them are left over.
    """
    count = choice.count()
    at = stored(choice.select("v", "parent", F.coalesce("parent", "v").alias("up"), F.col("parent").isNull().alias("there")), "lift")
    for _ in range(max(count, 1).bit_length() + 1):
        far = at.select(F.col("v").alias("up"), F.col("up").alias("__up"), F.col("there").alias("__there"))
        going = at.filter(~F.col("there")).join(far, "up", "left").select(
            "v", "parent", F.coalesce("__up", "up").alias("up"), F.coalesce("__there", F.lit(False)).alias("there"))
        at = stored(at.filter("there").unionByName(going), "lift")
        if at.filter(~F.col("there")).isEmpty():
            break
    return at.filter("there").select("v", "parent", F.col("up").alias("root"))


def _tour(forest: DataFrame) -> DataFrame:
    """``v, parent, root, before, size``: nodes of the same root that come before, and of the subtree.

    Siblings are ordered by ``v``.  Each node is entered and left; an element's weight counts the nodes
    entered from it to the end of the tour, and doubling adds the weight of the element it points to.
    """
    placed = dealt(forest.filter("parent IS NOT NULL").select("v", "parent"), ["parent", "v"], label="siblings")
    after = climb(placed.rows, placed.bins, leads={"__next": F.struct("parent", "v")})
    sibling = after.select("v", "parent", F.when(F.col("__next.parent") == F.col("parent"), F.col("__next.v")).alias("next_sibling"))
    eldest = sibling.groupBy(F.col("parent").alias("v")).agg(F.min("v").alias("child"))
    enter = forest.select("v").join(eldest, "v", "left").select(
        (F.col("v") * 2).alias("e"), F.coalesce(F.col("child") * 2, F.col("v") * 2 + 1).alias("next"), F.lit(1).cast("long").alias("n"))
    leave = sibling.select((F.col("v") * 2 + 1).alias("e"), F.coalesce(F.col("next_sibling") * 2, F.col("parent") * 2 + 1).alias("next"),
                           F.lit(0).cast("long").alias("n"))
    last = forest.filter("parent IS NULL").select((F.col("v") * 2 + 1).alias("e"), F.lit(None).cast("long").alias("next"), F.lit(0).cast("long").alias("n"))
    tour = stored(enter.unionByName(leave).unionByName(last), "tour")
    while not tour.filter("next IS NOT NULL").isEmpty():
        far = tour.select(F.col("e").alias("next"), F.col("next").alias("__next"), F.col("n").alias("__n"))
        going = tour.filter("next IS NOT NULL").join(far, "next").select("e", F.col("__next").alias("next"), (F.col("n") + F.col("__n")).alias("n"))
        tour = stored(tour.filter("next IS NULL").unionByName(going), "tour")
    rank = tour.groupBy(F.floor(F.col("e") / 2).alias("v")).agg(F.max("n").alias("n"), F.min("n").alias("rest"))
    ranked = forest.join(rank, "v")
    whole = ranked.filter("parent IS NULL").select("root", F.col("n").alias("__all"))
    return ranked.join(whole, "root").select("v", "parent", "root", (F.col("__all") - F.col("n")).alias("before"), (F.col("n") - F.col("rest")).alias("size"))


def _positions(choice: DataFrame) -> DataFrame:
    """``v, parent, root, pos, size`` with dense positions over all trees, roots in the order of ``v``."""
    tour = stored(_tour(_forest(choice)), "toured")
    tops = dealt(tour.filter("parent IS NULL").select("v", "size"), ["v"], label="roots")
    offsets = climb(tops.rows, tops.bins, sums={"__offset": F.col("size")}).select(F.col("v").alias("root"), "__offset")
    return stored(tour.join(offsets, "root").select("v", "parent", "root", (F.col("__offset") + F.col("before")).alias("pos"), "size"), "positions")


def _better_parents(at: DataFrame, choice: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that another parent would bring to an earlier place: ``v, parent``.

    Below a new parent a node would stand behind the subtrees of the smaller children there.  Of two
    parents with the same place the later one is on the smaller path.
    """
    several = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
    loose = choice.join(at.select("v"), "v", "left_anti").select("v")
    asking = several.union(loose).distinct()
    place = at.select(F.col("v").alias("parent"), F.col("pos").alias("p_pos"))
    asked = edges.join(asking, "v").join(place, "parent").join(
        at.select("v", "pos", F.col("parent").alias("now")), "v", "left").filter(~F.col("now").eqNullSafe(F.col("parent")) | F.col("pos").isNull())
    asked = asked.select("parent", "v", F.lit(1).alias("kind"), "p_pos", F.lit(None).cast("long").alias("end"))
    wanted = asked.select("parent").distinct()
    children = at.filter("parent IS NOT NULL").join(wanted, "parent", "left_semi").select(
        "parent", "v", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("p_pos"), (F.col("pos") + F.col("size")).alias("end"))
    line = dealt(asked.unionByName(children), ["parent", "v", "kind"], label="places")
    seen = climb(line.rows, line.bins, peaks={"__last": F.when(F.col("kind") == 0, F.struct("parent", "end"))}).filter("kind = 1")
    place = F.when(F.col("__last.parent") == F.col("parent"), F.col("__last.end")).otherwise(F.col("p_pos") + 1)
    best = seen.select("v", "parent", place.alias("place"), "p_pos").groupBy("v").agg(
        F.min(F.struct("place", (-F.col("p_pos")).alias("late"), "parent")).alias("b"))
    here = at.join(at.select(F.col("v").alias("parent"), F.col("pos").alias("p_pos")), "parent", "left").select("v", F.struct("pos", (-F.col("p_pos")).alias("late")).alias("here"))
    return best.join(here, "v", "left").filter(
        F.col("here").isNull() | (F.col("b.place") < F.col("here.pos"))
        | ((F.col("b.place") == F.col("here.pos")) & (F.col("b.late") < F.col("here.late")))).select("v", F.col("b.parent").alias("parent"))


def tree_order(nodes: DataFrame, edges: DataFrame, sort: list[str], id_: str = "id") -> DataFrame:
    """Depth-first order: adds ``root_id`` and the dense ``position``.

    Roots and children are each ordered by ``sort`` then id; every parent comes before its children.  A node
    below several parents stands at the first place that a depth-first walk comes to, whatever its depth
    there.  Links to unknown parents do not count.  Members of a cycle that no root leads to have no
    place and are left out.  Repeated rows of one id share its place.

    Nodes are numbered by ``sort`` and id once.  Each then takes one of its parents, and positions
    follow by an Euler tour; nodes with several parents move to the one that brings them to an earlier place
    until none does.  A graph without shared children needs one turn, of about 2 log2 n rounds.
    """
    keyed = nodes.groupBy(id_).agg(*(F.min(c).alias(c) for c in sort if c != id_))
    keyed = stored(number_rows(keyed, [*sort, id_], out="v").select(id_, "v"), "numbered")
    links = edges.join(keyed.select(F.col(id_).alias("child_id"), "v"), "child_id").join(
        keyed.select(F.col(id_).alias("parent_id"), F.col("v").alias("parent")), "parent_id")
    links = stored(links.filter("v <> parent").select("v", "parent").distinct(), "links")
    loops = edges.filter("child_id = parent_id").join(keyed.select(F.col(id_).alias("child_id"), "v"), "child_id").select("v").distinct()
    first = links.groupBy("v").agg(F.min("parent").alias("parent"))
    # a node that is only its own parent is a cycle, not a root
    lost = loops.join(first, "v", "left_anti")
    choice = stored(keyed.join(lost, "v", "left_anti").select("v").join(first, "v", "left"), "parents")
    while True:
        at = _positions(choice)
        moved = stored(_better_parents(at, choice, links), "moved")
        if moved.isEmpty():
            break
        choice = stored(choice.join(moved.select("v", F.col("parent").alias("__new")), "v", "left").select(
            "v", F.coalesce("__new", "parent").alias("parent")), "parents")
    names = keyed.select(F.col(id_).alias("root_id"), F.col("v").alias("root"))
    placed = keyed.join(at, "v").join(names, "root").select(id_, "root_id", F.col("pos").alias("position"))
    return nodes.join(placed, id_)


def traverse(nodes: DataFrame, edges: DataFrame, roots: DataFrame, sort: list[str], order: str = "depth",
             up: bool = False, id_: str = "id") -> DataFrame:
    """What a walk from each root meets, in order: ``start_id, node_id, depth, position``.

    ``order`` is ``depth`` (first) or ``breadth``; children, or with ``up`` parents, are taken in the order of
    ``sort``, then id.  The root has position 0 and every node is met once.  ``depth`` is the shortest distance.
    """
    links = _flipped(edges) if up else edges
    walk = stored(closure(links, roots).select(F.col("ancestor_id").alias("start_id"), "node_id", "depth"), "walk")
    ranks = stored(number_rows(nodes.groupBy(id_).agg(*(F.min(c).alias(c) for c in sort if c != id_)), [*sort, id_], out="r").select(
        F.col(id_).alias("node_id"), "r"), "ranks")
    within = walk.join(links.select(F.col("parent_id").alias("node_id"), F.col("child_id").alias("next_id")).distinct(), "node_id").select(
        "start_id", F.col("node_id").alias("from_id"), F.col("next_id").alias("node_id"), F.col("depth").alias("from_depth"))
    if order == "breadth":
        return _breadth(walk.join(ranks, "node_id"), within)
    if order != "depth":
        raise ValueError("order is depth or breadth")
    # the walk of each start is a graph of its own; links back to the start close cycles and don't count
    key = lambda c: F.struct("start_id", F.col(c).alias("node_id"))
    own = walk.join(ranks, "node_id").select(key("node_id").alias("id"), "start_id", "r", "depth")
    tied = within.filter(~F.col("node_id").eqNullSafe(F.col("start_id"))).select(key("node_id").alias("child_id"), key("from_id").alias("parent_id"))
    placed = tree_order(own, tied, ["start_id", "r"])
    starts = placed.filter("depth = 0").select("start_id", F.col("position").alias("__first"))
    return placed.join(starts, "start_id").select("start_id", F.col("id.node_id").alias("node_id"), "depth", (F.col("position") - F.col("__first")).alias("position"))


def _breadth(walk: DataFrame, within: DataFrame) -> DataFrame:
    """Level by level: a node stands by the first of its parents in the level above, then by its own rank."""
    walk, within = stored(walk, "levels"), stored(within, "steps")
    deepest = walk.agg(F.max("depth")).first()[0] or 0
    done = level = stored(walk.filter("depth = 0").select("start_id", "node_id", "depth", F.lit(0).cast("long").alias("position")), "level")
    for depth in range(1, deepest + 1):
        above = level.select("start_id", F.col("node_id").alias("from_id"), F.col("position").alias("by"))
        best = within.filter(F.col("from_depth") == depth - 1).join(above, ["start_id", "from_id"]).groupBy("start_id", "node_id").agg(F.min("by").alias("by"))
        here = walk.filter(F.col("depth") == depth).join(best, ["start_id", "node_id"])
        sizes = done.groupBy("start_id").agg(F.count(F.lit(1)).alias("__n"))
        numbered = number_rows(here, ["by", "r"], out="__i", keys=["start_id"])
        level = stored(numbered.join(sizes, "start_id").select("start_id", "node_id", "depth", (F.col("__i") + F.col("__n")).alias("position")), "level")
        done = done.unionByName(level)
    return done


def spread(marks: DataFrame, edges: DataFrame, fold: Callable[[Column], Column], merge: Callable[[Column, Column], Column]) -> DataFrame:
    """``id, mark`` after marks ``id, mark`` went along ``edges`` (``parent_id`` to ``child_id``) until nothing changes.

    One row per node that a mark reaches; only nodes whose mark changed pass it on.
    """
    links = edges.select(F.col("parent_id").alias("id"), F.col("child_id").alias("to")).distinct()
    held = moving = stored(marks, "marks")
    while not moving.isEmpty():
        come = moving.join(links, "id").groupBy("to").agg(fold("mark").alias("__come")).withColumnRenamed("to", "id")
        both = stored(held.join(come, "id", "full").select(
            "id", merge(F.col("mark"), F.col("__come")).alias("mark"), F.col("mark").alias("__was")), "marks")
        held, moving = both.select("id", "mark"), both.filter(~F.col("mark").eqNullSafe(F.col("__was"))).select("id", "mark")
    return held


def _either(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)).bitwiseOR(F.coalesce(b, F.lit(0)))


def tracks(nodes: DataFrame, edges: DataFrame, group: Column, id_: str = "id") -> DataFrame:
    """``track, id``: members of each track with all their ancestors and descendants.

    A track is a bit (at most 63 of them); masks go up and down the links, one row per node.
    """
    member = nodes.select(F.col(id_).alias("id"), group.alias("track")).filter(F.col("track").isNotNull())
    names = [r.track for r in member.select("track").distinct().orderBy("track").limit(64).collect()]
    if len(names) > 63:
        raise ValueError("more than 63 tracks")
    bits = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(1 << i).cast("long"))]) if names else None
    own = member.groupBy("id").agg(F.bit_or(bits[F.col("track")]).alias("mark")) if names else member.select("id", F.lit(0).cast("long").alias("mark"))
    both = spread(own, edges, F.bit_or, _either).unionByName(spread(own, _flipped(edges), F.bit_or, _either))
    masks = both.groupBy("id").agg(F.bit_or("mark").alias("mark"))
    of = F.filter(F.array(*[F.when(F.col("mark").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(n)) for i, n in enumerate(names)])
                  if names else F.array().cast("array<string>"), lambda t: t.isNotNull())
    return masks.select(F.explode(of).alias("track"), F.col("id").alias(id_))


def first_tracks(nodes: DataFrame, edges: DataFrame, group: Column, order: list[str], id_: str = "id") -> DataFrame:
    """``id, track``: each node in the one track that takes it first.

    Members are gone through in ``order``; one that no earlier member has taken takes itself and those of
    its ancestors and descendants that are still free.  A member takes part for certain as soon as
    no earlier undecided member is among its relatives, so all such members are decided in one turn.
    """
    listed = number_rows(nodes.select(F.col(id_).alias("id"), group.alias("track"), *dict.fromkeys(c for c in order if c != id_)),
                         ["id" if c == id_ else c for c in order], out="turn")
    listed = stored(listed.filter("track IS NOT NULL").groupBy("id").agg(F.min(F.struct("turn", "track")).alias("m")).select("id", "m.turn", "m.track"), "members")
    links = stored(edges.select("child_id", "parent_id").distinct(), "links")
    above = _flipped(links)

    def nearest(marks: DataFrame) -> DataFrame:
        """The smallest mark among a node's relatives and itself."""
        both = spread(marks, links, F.min, F.least).unionByName(spread(marks, above, F.min, F.least))
        return both.groupBy("id").agg(F.min("mark").alias("mark"))

    undecided, taken = listed.select("id", "turn"), None
    while not undecided.isEmpty():
        near = nearest(undecided.select("id", F.col("turn").alias("mark")))
        now = stored(undecided.join(near, "id").filter("turn = mark").select("id", F.col("turn").alias("mark")), "taking")
        new = nearest(now)
        taken = stored(new if taken is None else taken.unionByName(new).groupBy("id").agg(F.min("mark").alias("mark")), "taken")
        left = undecided.join(now, "id", "left_anti").join(taken, "id", "left")
        undecided = stored(left.filter(F.col("mark").isNull() | (F.col("mark") > F.col("turn"))).select("id", "turn"), "undecided")
    if taken is None:
        return listed.select(F.col("id").alias(id_), "track")
    return taken.join(listed.select(F.col("turn").alias("mark"), "track"), "mark").select(F.col("id").alias(id_), "track")


def trim(start: Column, end: Column, length: int) -> tuple[Column, Column]:
    """Shrink both ends; short features lose a quarter instead, tiny ones nothing."""
    size = end - start
    cut = F.when(size <= 2, 0).when(size < 2 * length, F.ceil(size / 4)).otherwise(length)
    return start + cut, end - cut


def pad(start: Column, end: Column, length: int, limit: Column | None = None) -> tuple[Column, Column]:
    """Widen both ends, not below zero and not beyond ``limit``."""
    wide = end + length
    return F.greatest(start - length, F.lit(0)), wide if limit is None else (
        F.when(limit.isNotNull() & (wide > limit), limit).otherwise(wide))
