"""Connected components and the search for links inside buckets, as joins on Spark.

Nothing here is collected: nodes, links and labels stay in tables, and every round is cut
from its past by a table written to the shared folder (``session.durable``), so a lost
executor costs a re-run of one round at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattweave.llm.bitmap import parted
from wattweave.session import durable


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links`` (a, b): the smallest id reachable.

    Distributed union-find by contraction. In a round every node is hung below the node of
    its neighbourhood (itself included) that comes first in the order of a hash, and links are
    renamed by these parents. Parents that hang below others stay linked to them, so nothing
    is lost. Nodes around one that comes first go in one round, and ways that descend in a
    random order are short, so few rounds do; they are then undone in the opposite order. A
    hot node costs no more than its number of links: only minima are taken, and skewed joins
    are split at run time.
    """
    links = durable(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    parents: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("id")).agg(
            F.min_by("b", F.xxhash64("b")).alias("near"), F.min(F.xxhash64("b")).alias("first")
        )
        parent = near.select("id", F.when(F.col("first") < F.xxhash64("id"), F.col("near")).otherwise(F.col("id")).alias("parent"))
        parent = durable(parent)
        parents.append(parent)
        links = durable(
            links.join(parent.select(F.col("id").alias("a"), F.col("parent").alias("pa")), "a")
            .join(parent.select(F.col("id").alias("b"), F.col("parent").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
    if not parents:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = parents[0].withColumnRenamed("parent", "root")
    for parent in parents[1:]:
        above = parent.select(F.col("id").alias("root"), F.col("parent").alias("above"))
        roots = roots.join(above, "root", "left").select("id", F.coalesce("above", "root").alias("root"))
    roots = durable(roots)
    smallest = roots.groupBy("root").agg(F.min("id").alias("component"))
    return durable(roots.join(smallest, "root").select("id", "component"))


#: Candidate groups of up to so many members have all their pairs checked; larger ones are joined by element.
SMALL_GROUP = 12


#: Open buckets of up to so many members have all their pairs checked; larger ones make candidate groups.
SMALL_BUCKET = 40

Expand = Callable[[Column], Column]
Likely = Callable[[DataFrame], DataFrame]


def linked(pairs: DataFrame, sets: DataFrame, percent: int, expand: Expand, likely: Likely = lambda pairs: pairs) -> DataFrame:
    """The pairs (a, b) that are ``likely`` and whose sets have a Jaccard similarity of ``percent`` or more, exactly."""
    pairs = durable(likely(pairs))
    # Only sets that pairs are left of are shuffled.
    left, right = (parted(sets, pairs.select(F.col(end).alias("key")), "id")[0] for end in ("a", "b"))
    left = left.select(F.col("id").alias("a"), F.col("packed").alias("left"), F.col("size").alias("left_size"))
    right = right.select(F.col("id").alias("b"), F.col("packed").alias("right"), F.col("size").alias("right_size"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.where(100 * F.least("left_size", "right_size") >= percent * F.greatest("left_size", "right_size"))
    common = F.size(F.array_intersect(expand(F.col("left")), expand(F.col("right"))))
    both = both.select("a", "b", "left_size", "right_size", common.alias("common"))
    return both.where(100 * F.col("common") >= percent * (F.col("left_size") + F.col("right_size") - F.col("common"))).select("a", "b")


def linked_components(
    rows: DataFrame,
    sets: DataFrame,
    percent: int,
    expand: Expand = lambda packed: packed,
    likely: Likely = lambda pairs: pairs,
) -> DataFrame:
    """(id, component) under all links inside the candidate groups of ``rows``.

    ``rows`` (key, id) are the members of buckets; ids that share large buckets, directly or
    over others, are a candidate group. ``sets`` (id, packed, size) has the set of each id and its
    size; ``expand`` makes the array of distinct items of what is packed, so that something
    shorter can be shuffled. Two ids are linked if their sets have a Jaccard similarity of
    ``percent`` or more; ``likely`` leaves out pairs (a, b) that have less, before sets are fetched.

    First every member of a bucket is checked against one of them, which settles buckets of
    two and makes most others one component. A pair inside a component can change nothing,
    so only buckets of three or more with several components are left open. Of these, small
    ones have all pairs across components checked, and the candidate groups that large ones
    make are looked through: all such pairs in small groups, those that ``_pairs_by_item``
    finds in large ones. That loses no link and emits no pairs that could not be one for their counts. Ids linked with none may
    be left out.
    """
    heads = rows.groupBy("key").agg(F.min_by("id", F.xxhash64("id")).alias("head"))
    starred = durable(rows.join(heads, "key"))
    stars = _links(starred)
    found = durable(linked(stars, sets, percent, expand, likely))
    labels, opened = _opened(rows, found)
    if opened.isEmpty():
        return labels
    opened = durable(opened.join(sets.select("id", "size"), "id"))
    little = opened.where(F.col("n") <= SMALL_BUCKET).select("key", "id", "component", "size")
    pairs = _across(little, little.select("key", *_other("id", "component", "size")), ["key"], percent)
    more = durable(pairs.join(stars, ["a", "b"], "left_anti"))
    stars = durable(stars.unionByName(more))
    found = durable(found.unionByName(linked(more, sets, percent, expand, likely)))
    large_keys = opened.where(F.col("n") > SMALL_BUCKET).select("key").distinct()
    if large_keys.isEmpty():
        return components(found)
    labels = components(found)
    groups = components(_links(starred.join(large_keys, "key", "left_semi")))
    groups = groups.withColumnRenamed("component", "group").join(sets.select("id", "size"), "id")
    members, large = _members(groups, labels)
    several = members.where("several")
    small = several.where(F.col("members") <= SMALL_GROUP)
    pairs = _across(small, small.select("group", *_other("id", "component", "size")), ["group"], percent)
    by_item = _pairs_by_item(large, sets.select("id", "packed"), percent, expand)
    pairs = pairs.unionByName(by_item).distinct()
    pairs = durable(pairs.join(stars, ["a", "b"], "left_anti"))
    if pairs.isEmpty():
        return labels
    return components(found.unionByName(linked(pairs, sets, percent, expand, likely)))


def _opened(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, component) under the links found, and (key, id, component, n) of buckets of three or more in several."""
    labels = components(found)
    own = durable(rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")))
    keys = own.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    keys = keys.where("n > 2 and low < high").select("key", "n")
    return labels, durable(own.join(keys, "key"))


def _links(starred: DataFrame) -> DataFrame:
    """(a, b) of the members of buckets and their heads."""
    stars = starred.where("id <> head")
    return durable(stars.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct())


def _members(groups: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, id, size, component, members, several) of all ids, and the ids of large groups of several components."""
    own = durable(groups.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")))
    spread = own.groupBy("group").agg(
        F.count("*").alias("members"), (F.min("component") < F.max("component")).alias("several")
    )
    members = durable(own.join(spread, "group"))
    return members, members.where(F.col("several") & (F.col("members") > SMALL_GROUP))


def _other(*names: str) -> list[Column]:
    return [F.col(name).alias(f"other_{name}") for name in names]


def _across(left: DataFrame, right: DataFrame, keys: list[str], percent: int, also: Column | None = None) -> DataFrame:
    """Pairs (a, b) across components with the same keys and sizes that allow a link."""
    apart = (F.col("component") != F.col("other_component")) & (
        100 * F.least("size", "other_size") >= percent * F.greatest("size", "other_size")
    )
    both = left.join(right, keys).where(apart if also is None else apart & also)
    return both.select(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")).distinct()


def _pairs_by_item(members: DataFrame, sets: DataFrame, percent: int, expand: Expand) -> DataFrame:
    """Pairs across components of a group that can be links, found by what sets them apart.

    The core of a group are the items of half its members or more. A member x is described
    by its marks: its items outside the core, and the core's items that it lacks. Two sets
    differ in as many items as their marks do. So with T marks each, x and y are linked if
    and only if T(x) + T(y) - 2 * (marks in common) is at most (|x| + |y|) * (100 - percent) /
    (100 + percent); or, with the weight w = (100 + percent) * T - (100 - percent) * size,
    if they have (w(x) + w(y)) / (2 * (100 + percent)) marks in common at least.

    If that is no mark at all, they are linked for their weights alone. Then either is linked
    to the member of least weight, too, so one pair with that member stands for all of these.
    Otherwise they meet at a mark. Marks are ordered, rare ones first, and behind the first
    one in common there must be room for the others, in both orders; marks at a place that
    leaves no room are left out, and so are items that members of one component only have.

    All of this is exact, and near copies of one text have few common marks, whatever their
    number.
    """
    whole = 100 + percent
    # Written first: Spark would expand the sets of all ids to leave out empty ones before the join.
    items = durable(members.join(sets, "id").drop("several")).withColumn("items", expand(F.col("packed"))).drop("packed")
    each = items.select("group", "id", "component", F.explode("items").alias("item"))
    holders = each.groupBy("group", "item").agg(
        F.count("*").alias("holders"), (F.min("component") < F.max("component")).alias("across")
    )
    holders = holders.where("holders > 1")
    sizes = members.select("group", "members").distinct()
    known = durable(holders.join(sizes, "group").withColumn("core", 2 * F.col("holders") >= F.col("members")))
    core = known.where("core").groupBy("group").agg(F.collect_list("item").alias("core_items"))
    own = items.join(core, "group", "left").withColumn("core_items", F.coalesce("core_items", F.array().cast("array<bigint>")))
    lacked = F.array_except("core_items", "items")
    marks = F.col("size") - (F.size("core_items") - F.size(lacked)) + F.size(lacked)
    weighed = own.withColumns({"lacked": lacked, "marks": marks}).withColumn(
        "weight", (whole * F.col("marks") - (100 - percent) * F.col("size")).cast("long")
    )
    # No member within the sizes that a link allows weighs less than this beside x.
    beside = (2 * percent * percent * F.col("size") / 100).cast("long") - whole * F.size("core_items")
    weighed = weighed.withColumn("beside", beside)
    weighed = durable(weighed.select("group", "id", "component", "size", "marks", "weight", "lacked", "beside"))

    least = weighed.groupBy("group").agg(F.min_by("id", "weight").alias("id")).select("id")
    least = weighed.join(least, "id", "left_semi").select("group", "weight", *_other("id", "component", "size"))
    least = least.withColumnRenamed("weight", "least_weight")
    light = _across(weighed, least, ["group"], percent, F.col("weight") + F.col("least_weight") <= 0)

    outside = each.drop("component").join(known.where("not core and across"), ["group", "item"])
    outside = outside.select("group", "id", F.struct(F.col("holders").alias("rarity"), F.lit(False).alias("lacks"), "item").alias("mark"))
    lacks = weighed.select("group", "id", F.explode("lacked").alias("item")).join(known.where("core"), ["group", "item"])
    rarity = (F.col("members") - F.col("holders")).alias("rarity")
    lacks = lacks.select("group", "id", F.struct(rarity, F.lit(True).alias("lacks"), "item").alias("mark"))
    order = outside.unionByName(lacks).groupBy("group", "id").agg(F.array_sort(F.collect_list("mark")).alias("order"))
    placed = weighed.drop("lacked", "group").join(order, "id").join(least.select("group", "least_weight"), "group")
    lightest = F.greatest("least_weight", "beside")
    common = F.greatest(F.lit(1), F.ceil((F.col("weight") + lightest) / (2 * whole)))
    alone = F.col("marks") - F.size("order")  # marks that no other component has: they come first
    room = (F.col("marks") - common + 1 - alone).cast("int")
    placed = placed.withColumn("alone", alone).where(room > 0).select(
        "group", "id", "component", "size", "marks", "weight", "alone", F.posexplode(F.slice("order", F.lit(1), room)).alias("at", "mark")
    )
    behind = (F.col("marks") - F.col("alone") - F.col("at")).cast("long").alias("room")
    placed = durable(placed.select("group", "id", "component", "size", "weight", behind, "mark.lacks", "mark.item"))
    # Of two components at least one isn't the largest of the group, so one side can leave that out.
    counts = weighed.groupBy("group", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("group").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    left = placed.join(largest, "group").where("component <> largest")
    right = placed.select("group", "lacks", "item", *_other("id", "component", "size", "weight", "room"))
    enough = 2 * whole * F.least("room", "other_room") >= F.col("weight") + F.col("other_weight")
    return _across(left, right, ["group", "lacks", "item"], percent, enough).unionByName(light)
