"""Column functions on names, labels, urls and volumes."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENT = re.compile(r"%(f|\d+)(?:\{([^}]*)\})?")


def to_float(c: Column) -> Column:
    """A number or null."""
    return c.try_cast("double")


def label(template: str, parts: dict[str, Column], arrays: tuple[str, ...] = (), trim_empty: bool = True, unique_neighbours: bool = True) -> Column:
    """A label from a template: ``%0``, ``%1{sep}`` name components (those in ``arrays`` are joined with sep), the rest are joiners.

    Empty components go with the joiner before them, so do components equal to their
    left neighbour; ``%f`` is the first component that isn't empty.
    """
    out: Column = F.lit("")
    before: Column = F.lit(None).cast("string")
    at = 0
    full = F.coalesce(*[F.nullif(_text(c, ", ", k in arrays), F.lit("")) for k, c in parts.items()], F.lit(""))
    for m in COMPONENT.finditer(template):
        joiner, at = template[at : m.start()], m.end()
        value = full if m[1] == "f" else F.coalesce(_text(parts[m[1]], m[2] or ", ", m[1] in arrays), F.lit(""))
        gone = F.lit(False)
        if trim_empty:
            gone = gone | (value == "")
        if unique_neighbours:
            gone = gone | value.eqNullSafe(before)
        out = F.concat(out, F.when(gone, "").otherwise(F.concat(F.when(out == "", "").otherwise(F.lit(joiner)) if trim_empty else F.lit(joiner), value)))
        before = F.when(gone, before).otherwise(value)
    return F.concat(out, F.lit(template[at:]))


def _text(c: Column, sep: str, is_array: bool) -> Column:
    return F.array_join(c, sep) if is_array else c.cast("string")


def viewer_url(base: str, x: Column, y: Column, z: Column, stack_id: int, zoom: int = 0, tool: str = "tracingtool") -> Column:
    number = lambda c: F.round(c).cast("long").cast("string")
    return F.concat(F.lit(f"{base}/?zp="), number(z), F.lit("&yp="), number(y), F.lit("&xp="), number(x), F.lit(f"&tool={tool}&sid0={stack_id}&s0={zoom}"))


def tile_url(kind: int, base: str, zoom: Column, row: Column, col: Column, z: Column, width: int, height: int, extension: str = "jpg") -> Column:
    """Addresses of image tiles in the layouts 1, 4 and 5."""
    s = lambda c: c.cast("string")
    if kind == 1:
        parts = [s(z), F.lit("/"), s(row), F.lit("_"), s(col), F.lit("_"), s(zoom)]
    elif kind == 4:
        parts = [s(z), F.lit("/"), s(zoom), F.lit("/"), s(row), F.lit("_"), s(col)]
    elif kind == 5:
        parts = [s(zoom), F.lit("/"), s(z), F.lit("/"), s(row), F.lit("/"), s(col)]
    else:
        raise ValueError(f"tile layout {kind}")
    return F.concat(F.lit(base), *parts, F.lit(f".{extension}"))


def downsample(level: Column, on_plane: bool) -> Column:
    """Default downsampling of an axis at a scale level: powers of 2 within the plane."""
    return F.pow(F.lit(2), level).cast("long") if on_plane else F.lit(1).cast("long")


def axis_coordinates(n: Column, resolution: Column, factor: Column, translation: Column) -> Column:
    return F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: i * resolution * factor + translation)


def mesh_points(x3d: Column) -> Column:
    """Vertices (array of arrays of three) in an X3D string."""
    text = F.regexp_extract(x3d, r"point=['\"]([^'\"]*)['\"]", 1)
    flat = F.transform(F.filter(F.split(text, r"[\s,]+"), lambda s: s != ""), lambda s: s.cast("double"))
    return F.when(F.size(flat) < 3, F.array().cast("array<array<double>>")).otherwise(F.transform(F.sequence(F.lit(0), (F.size(flat) / 3).cast("int") - 1), lambda i: F.slice(flat, i * 3 + 1, 3)))


def match_landmarks(members: DataFrame, locations: DataFrame, group1: str, group2: str) -> DataFrame:
    """(landmark, x1, y1, z1, x2, y2, z2) of landmarks in both groups that have one location in each. members: grp, landmark; locations: grp, landmark, x, y, z."""

    def side(group: str, n: int) -> DataFrame:
        own = locations.where(F.col("grp") == group).join(members.where(F.col("grp") == group).select("landmark").distinct(), "landmark", "left_semi")
        one = own.groupBy("landmark").agg(F.count("*").alias("n"), *[F.first(c).alias(f"{c}{n}") for c in "xyz"])
        return one.where("n = 1").drop("n")

    return side(group1, 1).join(side(group2, 2), "landmark")


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def name_words(name: Column) -> Column:
    """Words of a neuron's name as structs (word, says).

    Numbers, and ``neuron`` before a number, are generic. After the first generic word, capitals alone are a
    tracer's initials and other words a nickname; before it words are the type, and so is any other ``neuron``.
    """
    digits = lambda w: F.coalesce(w.rlike(r"^\d+$"), F.lit(False))

    def kinds(words: Column) -> Column:
        generic = F.transform(words, lambda w, i: digits(w) | ((w == "neuron") & digits(F.get(words, i + 1))))
        return _let(F.struct(generic.alias("generic"), F.array_position(generic, True).alias("first")), lambda k: F.transform(words, lambda w, i: F.struct(w.alias("word"), says(w, i, F.get(k["generic"], i), k["first"]).alias("says"))))

    def says(w: Column, i: Column, generic: Column, first: Column) -> Column:
        after = (first > 0) & (i + 1 > first)
        return F.when(generic, "generic").when(w == "neuron", "type").when(w.rlike(r"^\p{Lu}{2,}$") & after, "tracer").when(after, "nickname").otherwise("type")

    return _let(F.split(name, " "), kinds)


def parse_name(name: Column) -> Column:
    """Struct of type, nickname, tracer and generic words of a name."""

    def parts(words: Column) -> Column:
        of = lambda kind: F.array_join(F.transform(F.filter(words, lambda w: w["says"] == kind), lambda w: w["word"]), " ").alias(kind)
        return F.struct(of("type"), of("nickname"), of("tracer"), of("generic"))

    return _let(name_words(name), parts)


def shorten_name(name: Column, most: int = 30, mark: str = "[..]") -> Column:
    """The name with words replaced by a mark, in the order generic, tracer, nickname, type and each from the right, until it is short enough or one word is left."""
    of = lambda words, kind: F.filter(words, lambda w: w["says"] == kind)
    order = _let(F.reverse(name_words(name)), lambda words: F.concat(*[of(words, kind) for kind in ("generic", "tracer", "nickname", "type")]))

    def merged(s: Column) -> Column:
        return F.regexp_replace(s, re.escape(mark) + "(?: " + re.escape(mark) + ")+", mark)

    def step(now: Column, w: Column) -> Column:
        left = F.size(F.filter(F.split(F.trim(F.replace(now, F.lit(mark), F.lit(""))), " +"), lambda x: x != ""))
        return F.when((F.length(now) <= most) | (left <= 1), now).otherwise(merged(F.trim(F.replace(now, w["word"], F.lit(mark)))))

    return F.aggregate(order, name, step)


def point_columns(df: DataFrame, pattern: str, axes: str = "xyz") -> DataFrame:
    """Columns of one point, named by ``pattern`` with {} for the axis, as x, y and z."""
    return df.select(*[F.col(pattern.format(c)).alias(c) for c in axes])


def control_points(pairs: DataFrame) -> DataFrame:
    """Matched locations as two arrays of coordinates."""
    return pairs.select(*[F.array(*[F.col(f"{c}{n}") for c in "xyz"]).alias(f"points{n}") for n in (1, 2)])


def match_by_name(this: tuple[DataFrame, DataFrame], other: tuple[DataFrame, DataFrame], groups: tuple[str, str] | None = None) -> DataFrame:
    """(grp, landmark, x1 .. z2) of landmarks of one name in groups of two projects that have one location in each group.

    Each side is (members, locations) as for ``match_landmarks``. Without ``groups`` all groups of equal name are matched.
    """

    def side(tables: tuple[DataFrame, DataFrame], n: int, group: str | None) -> DataFrame:
        members, locations = tables
        own = locations.join(members.select("grp", "landmark").distinct(), ["grp", "landmark"], "left_semi")
        own = own if group is None else own.where(F.col("grp") == group)
        one = own.groupBy("grp", "landmark").agg(F.count("*").alias("n"), *[F.first(c).alias(f"{c}{n}") for c in "xyz"])
        return one.where("n = 1").drop("n")

    a, b = side(this, 1, groups and groups[0]), side(other, 2, groups and groups[1])
    if groups is None:
        return a.join(b, ["grp", "landmark"]).orderBy("grp", "landmark")
    return a.join(b.drop("grp"), "landmark").select("grp", "landmark", *[f"{c}{n}" for n in (1, 2) for c in "xyz"])


def group_members(members: DataFrame, locations: DataFrame) -> DataFrame:
    """Per group its landmarks, and the number of locations of them."""
    own = members.groupBy("grp").agg(F.array_sort(F.collect_set("landmark")).alias("landmarks"))
    n = locations.groupBy("grp").agg(F.count("*").alias("n_locations"))
    return own.join(n, "grp", "left").select("grp", "landmarks", F.coalesce("n_locations", F.lit(0)).alias("n_locations"))


#: The axes of an image stack by its orientation.
ORIENTATIONS = {0: "xy", 1: "xz", 2: "zy"}


def axis_order(orientation: Column, reverse: bool = False) -> Column:
    """The axes of a stack, those of its plane first and then the other."""
    full = {k: v + next(c for c in "xyz" if c not in v) for k, v in ORIENTATIONS.items()}
    table = F.create_map(*[F.lit(x) for k, v in full.items() for x in (k, v[::-1] if reverse else v)])
    return F.try_element_at(table, orientation)


def orientation_of(axes: Column) -> Column:
    """The number of the orientation with these two axes of a plane."""
    return F.try_element_at(F.create_map(*[F.lit(x) for k, v in ORIENTATIONS.items() for x in (v, k)]), axes)


def mirrors(stacks: DataFrame, stack: str, mirror: str) -> DataFrame:
    """Image bases of a stack and mirror, each by id or title. stacks: stack_id, title, mirrors (array of structs of id, title, ...)."""
    fits = lambda i, t, v: (i.cast("string") == v) | (t == v)
    own = stacks.where(fits(F.col("stack_id"), F.col("title"), stack)).select("stack_id", F.explode("mirrors").alias("m"))
    return own.where(fits(F.col("m.id"), F.col("m.title"), mirror)).select("stack_id", "m.*")


def whole_slices(broken: DataFrame, last: int | None = None) -> DataFrame:
    """(slice, use): each broken slice with the whole one that stands for it; what replaces may be broken itself. broken: slice, step (to the replacement). Replacements below 0 or behind ``last`` don't count; None is a stack without an end."""
    from ..operators.trees import to_root

    jump = broken.select(F.col("slice").alias("node_id"), (F.col("slice") + F.col("step")).alias("parent_id"))
    ends = jump.select(F.col("parent_id").alias("node_id")).distinct().join(jump.select("node_id"), "node_id", "left_anti").select("node_id", F.lit(None).cast("long").alias("parent_id"))
    found = to_root(jump.unionByName(ends), F.lit(0.0)).select(F.col("node_id").alias("slice"), F.col("root").alias("use"))
    inside = F.col("use") >= 0 if last is None else F.col("use").between(0, last)
    return found.where((F.col("slice") != F.col("use")) & inside)


def tile_memory(tiles: DataFrame, width: int, keys: tuple[str, ...] = ("col", "row", "z")) -> DataFrame:
    """Bytes of all distinct tiles."""
    return tiles.select(*keys).distinct().agg((F.count("*") * width * width * 8).alias("bytes"))


def boxes_around(points: DataFrame, size: tuple[float, float] = (500.0, 500.0)) -> DataFrame:
    """Boxes of a size in the plane around points (x, y, z)."""
    (w, h), half = size, lambda v: v / 2
    return points.select("*", *[(F.col(c) + s * half(v)).alias(f"{c}{n}") for c, v in (("x", w), ("y", h)) for n, s in ((1, -1), (2, 1))], F.col("z").alias("z1"), F.col("z").alias("z2"))


def mesh_faces(x3d: Column) -> Column:
    """Triangles (array of arrays of three vertex numbers, from 0) in an X3D string of a triangle set, or of a face set whose faces have three corners."""
    text = F.regexp_extract(x3d, r"(?:coordIndex|index)=['\"]([^'\"]*)['\"]", 1)
    flat = F.filter(F.transform(F.filter(F.split(text, r"[\s,]+"), lambda s: s != ""), lambda s: s.cast("int")), lambda i: i >= 0)
    return F.when(F.size(flat) < 3, F.array().cast("array<array<int>>")).otherwise(F.transform(F.sequence(F.lit(0), (F.size(flat) / 3).cast("int") - 1), lambda i: F.slice(flat, i * 3 + 1, 3)))


def landmark_locations(landmarks: DataFrame) -> DataFrame:
    """A row a landmark and location. landmarks: landmark_id, name, locations (array of structs of id, x, y, z)."""
    return landmarks.select("landmark_id", "name", F.explode("locations").alias("at")).select("landmark_id", "name", F.col("at.id").alias("location_id"), "at.x", "at.y", "at.z")


def resolve_nodes(terms: DataFrame, nodes: DataFrame | None = None, connectors: DataFrame | None = None) -> DataFrame:
    """(node_id): ids from text or numbers (term), and those of tables of nodes (node_id) and connectors (connector_id), each once; what is no number is left out."""
    out = terms.select(F.col("term").cast("string").try_cast("long").alias("node_id")).where("node_id IS NOT NULL")
    if nodes is not None:
        out = out.unionByName(nodes.select("node_id"))
    if connectors is not None:
        out = out.unionByName(connectors.select(F.col("connector_id").alias("node_id")))
    return out.distinct()
