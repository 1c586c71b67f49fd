"""Problem 5: one surviving record per group of rows for one page.

Method: currency reasoning. From rows with timestamps the engine learns which values follow which:
a precedence between the values of an attribute, voted for by all groups, without circles. A group
then has a partial order. Of two rows with timestamps the later one is later; a row without one is
later than another if in no attribute its value precedes the other's and in some attribute it
follows it (the product of the learned orders, which is transitive). Each field of the survivor is
the topologically latest known value: that of a row that no other row is later than.

Groups are the components of: same image, equal asset_id, canonical_asset_id naming an asset_id.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.text import non_blank
from pagemill.llm.graph import components
from pagemill.llm.hamming import hamming_pairs, informative
from pagemill.session import cut_lineage

#: Attributes whose order of values is learned. Each has at most some hundred values, whatever the
#: data: fields present (0-3), eighths of an octave of area, file kind, domain.
ATTRIBUTES = ("present", "scale", "kind", "domain")
#: Fields that survive by currency.
FIELDS = ("asset_id", "image_path", "phash", "fetched_at", "domain")


def instant(c: Column) -> Column:
    """ISO text in any zone as a TIMESTAMP; without a zone it is UTC; null if it is no time."""
    s = F.trim(c)
    zoned = s.rlike(r"([zZ]|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, s.try_cast("timestamp")).otherwise(F.concat(s, F.lit("Z")).try_cast("timestamp"))


def features(assets: DataFrame) -> DataFrame:
    """One row per asset row: keys, measures and attributes, under names of our own."""
    w, h = F.col("width"), F.col("height")
    area = F.coalesce(w.cast("bigint") * h.cast("bigint"), F.lit(0).cast("bigint"))
    present = F.when(F.col("phash").isNotNull(), 1).otherwise(0) + F.when(w.isNotNull(), 1).otherwise(0) + F.when(h.isNotNull(), 1).otherwise(0)
    return assets.select(
        "ord",
        F.lower(F.trim("sha256")).alias("sha"),
        informative(F.col("phash")).alias("code"),
        "asset_id",
        non_blank(F.col("canonical_asset_id")).alias("canonical"),
        present.alias("present"),
        area.alias("area"),
        instant(F.col("fetched_at")).alias("at"),
        F.when(area > 0, F.floor(F.log2(area.cast("double")) * 8)).cast("string").alias("scale"),
        F.when(F.lower(F.substring_index("image_path", ".", -1)).isin("png", "jpg", "jpeg", "webp", "gif"), F.lower(F.substring_index("image_path", ".", -1))).alias("kind"),
        F.when(F.col("domain").isin("manga", "webtoon"), F.col("domain")).alias("domain"),
        F.struct("asset_id", "image_path", "phash", "width", "height", "fetched_at", "domain").alias("row"),
    ).where("ord is not null")


def same_page_edges(rows: DataFrame, radius: int = 6) -> DataFrame:
    """(u, v): row numbers that belong together. Each key joins its rows in a star to the smallest."""

    def first(key: str) -> DataFrame:
        return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("ord").alias("v"))

    stars = []
    for key in ("sha", "asset_id", "code"):
        stars.append(rows.select(F.col("ord").alias("u"), key).join(first(key), key).select("u", "v"))
    by_asset = first("asset_id").select(F.col("asset_id").alias("canonical"), "v")
    stars.append(rows.select(F.col("ord").alias("u"), "canonical").join(by_asset, "canonical").select("u", "v"))
    codes = cut_lineage(first("code"), "p5-codes")
    near = hamming_pairs(codes.select("code"), radius=radius)
    stars.append(near.join(codes.select(F.col("code").alias("code_a"), F.col("v").alias("u")), "code_a").join(codes.select(F.col("code").alias("code_b"), "v"), "code_b").select("u", "v"))
    out = stars[0]
    for s in stars[1:]:
        out = out.unionByName(s)
    return out.where("u != v")


def grouped(assets: DataFrame, radius: int = 6) -> DataFrame:
    """The rows that belong to a group of two or more, with ``group_ord``, its smallest ord."""
    rows = cut_lineage(features(assets), "p5-rows")
    roots = components(same_page_edges(rows, radius))
    return cut_lineage(rows.join(roots.select(F.col("node").alias("ord"), F.col("root").alias("group_ord")), "ord"), "p5-groups")


def learn_precedence(rows: DataFrame) -> dict[str, dict[str, set[str]]]:
    """Per attribute and value the values that come after it.

    In each group the values of an attribute are put in order of first sight; each step from one
    to the next is a vote over all groups. Votes enter the order by support, one that would close
    a circle is left out; what follows is closed over chains of steps.
    """
    pairs = [F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in ATTRIBUTES]
    seen = rows.where("at is not null").select("group_ord", "at", F.inline(F.array(*pairs))).where("value is not null").groupBy("group_ord", "attribute", "value").agg(F.min("at").alias("first"))
    w = Window.partitionBy("group_ord", "attribute").orderBy("first", "value")
    steps = seen.select("attribute", F.lag("value").over(w).alias("a"), F.col("value").alias("b"), (F.lag("first").over(w) < F.col("first")).alias("later")).where("later")
    votes: dict[str, dict[tuple[str, str], int]] = defaultdict(dict)
    for r in steps.groupBy("attribute", "a", "b").agg(F.count("*").alias("n")).collect():
        votes[r["attribute"]][r["a"], r["b"]] = r["n"]
    out = {}
    for attribute, v in votes.items():
        net = {(a, b): n - v.get((b, a), 0) for (a, b), n in v.items()}
        above: dict[str, set[str]] = defaultdict(set)

        for (a, b), n in sorted(net.items(), key=lambda x: (-x[1], x[0])):
            if n > 0 and a != b and a not in below(b, above):
                above[a].add(b)
        out[attribute] = {x: set(below(x, above)) for x in {x for pair in v for x in pair}}
    return out


def below(x: str, above: dict[str, set[str]]) -> set[str]:
    """All values that come after ``x``."""
    todo, done = list(above.get(x, ())), set()
    while todo:
        z = todo.pop()
        if z not in done:
            done.add(z)
            todo.extend(above.get(z, ()))
    return done


def later(precedence: dict[str, dict[str, set[str]]]):
    """A function of two profiles (structs of ATTRIBUTES): whether the second is later than the first.
    A missing value is before every known one."""
    after = {a: F.create_map(*[x for v, more in sorted(p.items()) for x in (F.lit(v), F.array(*[F.lit(m) for m in sorted(more)]).cast("array<string>"))]) for a, p in precedence.items() if p}

    def compare(p: Column, q: Column) -> Column:
        never, some = F.lit(True), F.lit(False)
        for a in ATTRIBUTES:
            x, y = p[a], q[a]
            follows = (x.isNull() & y.isNotNull()) | (F.coalesce(F.array_contains(F.element_at(after[a], x), y), F.lit(False)) if a in after else F.lit(False))
            never, some = never & (follows | x.eqNullSafe(y)), some | follows
        return never & some

    return compare


def latest_fields(rows: DataFrame, precedence: dict[str, dict[str, set[str]]]) -> DataFrame:
    """(group_ord, FIELDS): the topologically latest known value of each field.

    Of the rows that know the field, the latest with a time stands against those without one; these
    count once per profile of attribute values, of which there are some hundreds at most whatever
    the group, the row of smallest ord for each. If one of these is later than the timed row, the
    survivor is one of them that no other is later than; else it is the timed row. Without a timed
    row it is the first of them by ord that no other is later than."""
    profile = F.struct(*[F.col(a).cast("string").alias(a) for a in ATTRIBUTES])
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col("row")[f].cast("string").alias("value")) for f in FIELDS])
    known = rows.select("group_ord", "ord", "at", profile.alias("profile"), F.inline(cells)).where("value is not null")
    timed = F.col("at").isNotNull()
    # equal times: the smaller ord; rows without time: per profile the smaller ord
    per = known.groupBy("group_ord", "field", F.when(~timed, F.col("profile")).alias("untimed")).agg(F.max(F.struct("at", (-F.col("ord")).alias("o"), "value", "profile")).alias("r"))
    compare = later(precedence)
    both = per.groupBy("group_ord", "field").agg(F.max(F.when(F.col("r.at").isNotNull(), F.col("r"))).alias("t"), F.collect_list(F.when(F.col("r.at").isNull(), F.col("r"))).alias("u"))
    over = F.filter("u", lambda x: F.col("t").isNull() | compare(F.col("t.profile"), x["profile"]))
    top = F.filter("over", lambda x: ~F.exists("over", lambda y: compare(x["profile"], y["profile"])))
    first = F.array_max(F.transform("top", lambda x: F.struct(x["o"].alias("o"), x["value"].alias("value"))))["value"]
    chosen = both.withColumn("over", over).withColumn("top", top).select("group_ord", "field", F.coalesce(first, F.col("t.value")).alias("value"))
    return chosen.groupBy("group_ord").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS])


def surviving_rows(rows: DataFrame, precedence: dict[str, dict[str, set[str]]]) -> DataFrame:
    """(group_ord, best_ord, exact): per group its topologically latest row, and whether that row alone
    reaches the group's maximum of present fields, area and time.

    The group's partial order: a row is later than one that it equals or exceeds in time (no time is
    before every time), present fields and area, and exceeds in one of them. Among the rows that no
    other is later than, learned precedence orders what these leave open; where it would contradict
    them it has no say, so there are no circles. Of several latest rows the one of smallest ord survives.

    The rows of one profile of attribute values are aggregated first, as in ``latest_fields``: its
    latest row, of these the largest, stands for it. A row that is best in everything is that row, and
    then it is the only one that no other is later than.
    """
    profile = F.struct(*[F.col(a).cast("string").alias(a) for a in ATTRIBUTES])
    equal = rows.groupBy("group_ord", "present", profile.alias("profile"), "at", "area").agg(F.count("*").alias("n"), F.min("ord").alias("ord"))
    r = F.max(F.struct("at", "area", (-F.col("ord")).alias("o"), "n", "present", "profile")).alias("r")
    # the largest area of a group need not be that of a profile's latest row
    profiles = equal.groupBy("group_ord", "profile").agg(r, F.max("area").alias("area"))
    groups = profiles.groupBy("group_ord").agg(F.collect_list("r").alias("all"), F.max("area").alias("area"), *[F.max(F.col("r")[m]).alias(m) for m in ("at", "present")])

    def above(x: Column, y: Column) -> Column:
        """Whether ``y`` is later than ``x`` by the measures."""
        order = [(x[m].isNull() & y[m].isNotNull()) | F.coalesce(x[m] < y[m], F.lit(False)) for m in ("at", "present", "area")]
        same = [x[m].eqNullSafe(y[m]) for m in ("at", "present", "area")]
        return (order[0] | same[0]) & (order[1] | same[1]) & (order[2] | same[2]) & (order[0] | order[1] | order[2])

    compare = later(precedence)
    open_ = F.filter("all", lambda x: ~F.exists("all", lambda y: above(x, y)))
    last = F.filter("open", lambda x: ~F.exists("open", lambda y: compare(x["profile"], y["profile"])))
    first = F.array_max(F.transform("last", lambda x: F.struct(x["o"].alias("o"), x["at"].alias("at"), x["present"].alias("present"), x["area"].alias("area"))))
    best = lambda x: F.coalesce((x["at"] == F.col("at")) & (x["present"] == F.col("present")) & (x["area"] == F.col("area")), F.lit(False))
    number = F.aggregate(F.filter("all", best), F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    out = groups.withColumn("open", open_).withColumn("last", last).withColumn("s", first)
    return out.select("group_ord", (-F.col("s.o")).alias("best_ord"), (best(F.col("s")) & (number == 1)).alias("exact"))


def best_of(rows: DataFrame, precedence: dict[str, dict[str, set[str]]]) -> DataFrame:
    """(group_ord, best_ord) of the groups whose surviving row is the only one best in everything."""
    return surviving_rows(rows, precedence).where("exact").select("group_ord", "best_ord")


def survivors(assets: DataFrame, radius: int = 6) -> DataFrame:
    """One row per group: group_ord, rows, best_ord and the surviving fields.

    best_ord is the only row that reaches the group's maximum of present fields, area and time, or
    null if none or several do. width and height survive together from the largest known area,
    the other fields are the topologically latest known values. Rows without ord are left out; a
    missing time is no time; an empty table gives no rows; extra columns do not matter.
    """
    rows = grouped(assets, radius)
    precedence = learn_precedence(rows)
    fields = latest_fields(rows, precedence)
    size = F.max(F.when(F.col("area") > 0, F.struct("area", "at", (-F.col("ord")).alias("o"), F.col("row.width").alias("width"), F.col("row.height").alias("height"))))
    sizes = rows.groupBy("group_ord").agg(F.count("*").alias("rows"), size.alias("s")).select("group_ord", "rows", F.col("s.width").alias("width"), F.col("s.height").alias("height"))
    return sizes.join(best_of(rows, precedence), "group_ord", "left").join(fields, "group_ord", "left").select("group_ord", "rows", "best_ord", *FIELDS, "width", "height")


def best_rows(assets: DataFrame, radius: int = 6) -> DataFrame:
    """(group_ord, best_ord) of the groups in which one row is best in everything: the surviving row of
    the group's order of times, measures and learned precedence, checked for all three measures."""
    rows = grouped(assets, radius)
    return best_of(rows, learn_precedence(rows))
