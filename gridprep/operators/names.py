"""Names, codes and mappings: bridges, matches, replacements, overlaps, key differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]


def bridge(mapping: DataFrame, name: str = "name", codes: str = "codes", code: str = "code") -> DataFrame:
    """One row for each code of each name."""
    return mapping.select(name, F.explode(codes).alias(code)).distinct()


def country_cells(mapping: DataFrame, admin: DataFrame) -> DataFrame:
    """name, cell: M:N, as a name has several codes and a code may have several names."""
    return bridge(mapping).join(admin.select("cell", "code"), "code").select("name", "cell")


def match_prioritised(left: DataFrame, right: DataFrame, keys: Keys, value: str) -> DataFrame:
    """left with ``value`` by the first key that matches, and ``matched_by``; right's keys must be unique (lowest value)."""
    for k in keys:
        table = right.filter(F.col(k).isNotNull()).groupBy(k).agg(F.min(value).alias(f"__{k}"))
        left = left.join(table, k, "left")
    found = F.coalesce(*(F.col(f"__{k}") for k in keys))
    by = F.coalesce(*(F.when(F.col(f"__{k}").isNotNull(), F.lit(k)) for k in keys))
    return left.withColumn(value, found).withColumn("matched_by", by).drop(*(f"__{k}" for k in keys))


def fuzzy_match(left: DataFrame, right: DataFrame, left_names: Keys = ("name_a", "name_b"), right_name: str = "name", cut=None) -> DataFrame:
    """One-to-one: (id, match, how) by exact name A, then exact name B, then the smallest edit distance among what is
    unused, if it is under half the name's length.

    Distances are only looked at between names that share a pair of adjacent letters or, where name A's length is odd,
    the first and the last letter, and differ in length by less than half the longer. Any closer pair does: fewer edits
    than half the length can't touch every second pair of an even length, and of an odd one only with one edit in each,
    which leaves the letter before or after those pairs where it is, first or last. The closest pairs are taken round by
    round, each id and each name once.
    """
    cut = cut or (lambda d: d)
    out = None
    rest_left, rest_right = left, right.select(F.col(right_name).alias("match")).distinct()
    for n in left_names:
        hit = rest_left.join(rest_right, F.col(n) == F.col("match")).groupBy("match").agg(F.min("id").alias("id")).select("id", "match", F.lit(n).alias("how"))
        hit = cut(hit)
        out = hit if out is None else out.unionByName(hit)
        rest_left, rest_right = rest_left.join(hit, "id", "left_anti"), rest_right.join(hit, "match", "left_anti")
    a = left_names[0]
    pairs = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.lower(F.substr(c, i, F.lit(2)))))
    ends = lambda c: F.array(F.concat(F.lower(F.left(c, F.lit(1))), F.lit("\n\n"), F.lower(F.right(c, F.lit(1)))))
    odd = F.when(F.length("a") % 2 == 1, ends(F.col("a"))).otherwise(F.array().cast("array<string>"))
    x = rest_left.select("id", F.col(a).alias("a")).withColumn("p", F.explode(F.concat(pairs(F.col("a")), odd)))
    y = rest_right.withColumn("p", F.explode(F.concat(pairs(F.col("match")), ends(F.col("match")))))
    near = x.join(y, "p").filter(F.abs(F.length("a") - F.length("match")) * 2 < F.greatest(F.length("a"), F.length("match"))).select("id", "a", "match").distinct()
    near = near.withColumn("d", F.levenshtein("a", "match")).filter(F.col("d") * 2 < F.length("a")).select("id", "match", "d")
    near = cut(near)
    while not near.isEmpty():
        order = F.struct("d", "id", "match")
        mine = near.groupBy("id").agg(F.min(order).alias("o")).select("o.*")
        theirs = near.groupBy("match").agg(F.min(order).alias("o")).select("o.*")
        hit = cut(mine.join(theirs, ["d", "id", "match"], "left_semi").select("id", "match", F.lit("distance").alias("how")))
        out = out.unionByName(hit)
        near = cut(near.join(hit, "id", "left_anti").join(hit, "match", "left_anti"))
    return out


def remap_codes(df: DataFrame, rules: DataFrame, known: DataFrame, code: str = "code", enclosing: str | None = None) -> DataFrame:
    """The code's replacement; else the code itself if known; else the first known code of ``enclosing`` (an array)."""
    k = known.select(F.col("code").alias("__k")).distinct()
    out = df.withColumn("__row", F.monotonically_increasing_id()) if enclosing else df
    out = out.join(rules.select(F.col("code").alias(code), "replacement"), code, "left").join(k, F.col(code) == F.col("__k"), "left")
    new = F.coalesce("replacement", "__k")
    if enclosing:
        listed = out.select("__row", F.posexplode(enclosing).alias("pos", "c")).join(k.withColumnRenamed("__k", "c"), "c").groupBy("__row").agg(F.min_by("c", "pos").alias("__first"))
        out = out.join(listed, "__row", "left").withColumn("new_code", F.coalesce(new, "__first")).drop("__first", "__row")
    else:
        out = out.withColumn("new_code", new)
    return out.drop("replacement", "__k")


def add_from_template(df: DataFrame, add: DataFrame, keys: Keys = ("name", "code")) -> DataFrame:
    """Rows of ``add`` (keys, template) with the template's other columns; skipped if a key is taken or the template unknown."""
    for k in keys:
        add = add.join(df.select(k).distinct(), k, "left_anti")
    others = [c for c in df.columns if c not in keys]
    template = df.select(F.col(keys[0]).alias("template"), *others)
    return df.unionByName(add.select(*keys, "template").join(template, "template").select(*df.columns))


def resolve_overlaps(active: DataFrame, mapping: DataFrame, has_data: DataFrame) -> DataFrame:
    """(year, name) left of the active names once no code is in two: a name all of whose codes other active names cover
    is a group and goes if all those parts have data, else its parts go; a name only partly covered makes the parts go.

    ``active``: year, name; ``mapping``: name, code; ``has_data``: year, name.
    """
    own = active.join(mapping, "name")
    size = own.groupBy("year", "name").agg(F.count(F.lit(1)).alias("size"))
    sized = own.join(size, ["year", "name"])
    part = sized.select("year", "code", F.col("name").alias("part"), F.col("size").alias("part_size"))
    # the larger of two names is the group; equal sizes: the later by name
    met = sized.join(part, ["year", "code"]).filter((F.col("part") != F.col("name")) & ((F.col("part_size") < F.col("size")) | ((F.col("part_size") == F.col("size")) & (F.col("part") < F.col("name")))))
    covered = met.groupBy("year", "name", "size").agg(F.count_distinct("code").alias("covered"))
    parts = met.select("year", "name", "part").distinct().join(has_data.select("year", F.col("name").alias("part")).withColumn("ok", F.lit(True)), ["year", "part"], "left")
    complete = parts.groupBy("year", "name").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("all_ok"))
    verdict = covered.join(complete, ["year", "name"]).withColumn("drop_group", (F.col("covered") == F.col("size")) & F.col("all_ok"))
    gone = verdict.filter("drop_group").select("year", "name").unionByName(parts.join(verdict.filter("not drop_group"), ["year", "name"]).select("year", F.col("part").alias("name"))).distinct()
    return active.join(gone, ["year", "name"], "left_anti")


def dedupe_mapping(mapping: DataFrame, known: DataFrame) -> DataFrame:
    """Names without those that have another's very code set and no data of their own (``known``: name)."""
    sets = mapping.groupBy("name").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    flagged = sets.join(known.select("name").distinct().withColumn("ok", F.lit(True)), "name", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    w = Window.partitionBy("codes")
    return flagged.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("any", F.max("ok").over(w)).filter("n = 1 or ok or not any").select("name", "codes")


def overlay_sources(a: DataFrame, b: DataFrame, keys: Keys, value: str) -> DataFrame:
    """The second source over the first, unless it is null."""
    second = b.select(*keys, F.col(value).alias("__b"))
    return a.select(*keys, value).join(second, [*keys], "full_outer").select(*keys, F.coalesce("__b", value).alias(value))


def key_diff(a: DataFrame, b: DataFrame, keys: Keys) -> DataFrame:
    """Keys that only one of the tables has, with ``side`` a or b."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.join(y, [*keys], "left_anti").withColumn("side", F.lit("a")).unionByName(y.join(x, [*keys], "left_anti").withColumn("side", F.lit("b")))


def order_levels(df: DataFrame, cols: Keys) -> DataFrame:
    """level, n: the admin columns by their number of distinct codes, most first; the last one is the country's."""
    one = df.agg(*(F.count_distinct(c).alias(c) for c in cols))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("level"), F.col(c).alias("n")) for c in cols))).alias("x")).select("x.*")


def unpivot_years(df: DataFrame, ids: Keys, value: str = r"^Y(\d{4})$", flag: str = r"^Y(\d{4})F$") -> DataFrame:
    """Wide yearly columns as rows: ids, year, value, flag. A key that occurs twice is an error."""
    import re

    years = {re.match(value, c)[1]: c for c in df.columns if re.match(value, c)}
    flags = {re.match(flag, c)[1]: c for c in df.columns if re.match(flag, c)}
    cells = F.array(*(F.struct(F.lit(int(y)).alias("year"), F.col(c).cast("double").alias("value"), (F.col(flags[y]) if y in flags else F.lit(None)).cast("string").alias("flag")) for y, c in sorted(years.items())))
    n = F.count(F.lit(1)).over(Window.partitionBy(*ids))
    checked = df.withColumn("__n", n).withColumn("__ok", F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat_ws(" ", F.lit("repeated key"), *ids)).cast("boolean")))
    return checked.filter("__ok").select(*ids, F.explode(cells).alias("x")).select(*ids, "x.year", "x.value", "x.flag")
