"""Vector features: GeoJSON in and out, and layers by query, name or index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Decimals of written coordinates. Fixed value.
DECIMALS = 8
GEOMETRY = "struct<type:string, coordinates:string, geometries:array<struct<type:string, coordinates:string>>>"
ONE = f"struct<properties:map<string,string>, geometry:{GEOMETRY}>"
#: A feature, a collection of features, or a bare geometry.
DOCUMENT = f"type string, properties map<string,string>, geometry {GEOMETRY}, features array<{ONE}>, coordinates string, geometries array<struct<type:string, coordinates:string>>"
GEOMETRIES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon", "GeometryCollection")


def geojson(ring: Column, properties: Column, closed: bool = True) -> Column:
    """One feature as a line of JSON: a polygon of rings, or line strings."""
    rounded = F.transform(ring, lambda r: F.transform(r, lambda v: F.array(F.round(v["x"], DECIMALS), F.round(v["y"], DECIMALS))))
    geometry = F.struct(F.lit("Polygon" if closed else "MultiLineString").alias("type"), rounded.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")))


def write_geojson(features: DataFrame, rings: str, properties: list[str], path: str, closed: bool = True) -> None:
    """A feature in each line, many files; readers of line-wise GeoJSON take the folder."""
    props = F.create_map(*[x for p in properties for x in (F.lit(p), F.col(p).cast("string"))])
    features.select(geojson(F.col(rings), props, closed).alias("value")).write.text(path)


def scan_features(spark: SparkSession, path: str, by_line: bool | None = None) -> DataFrame:
    """Features of GeoJSON files: properties as strings, geometry type, and rings of vertices.

    Files are line-wise (a document in each line, read in splits), or hold one document over several lines; a file counts as
    line-wise if its first line with more than white space is a whole document. Files of the other kind are read whole, one
    a task at a time. To tell, the text is read once before; ``by_line`` says it instead. What is no document is counted by
    ``unread_documents``."""
    return parse_features(documents(spark, path, by_line))


def documents(spark: SparkSession, path: str, by_line: bool | None = None) -> DataFrame:
    """(value): the GeoJSON documents of files, from lines and from files that are one document."""
    if by_line is not None:
        return spark.read.text(path, wholetext=not by_line)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.filter("trim(value) <> ''").withColumn("place", F.monotonically_increasing_id())
    # a file's first line stands in its first split, before the file's others
    first = first.groupBy("file").agg(F.min_by("value", F.struct("at", "place")).alias("line"))
    split = first.filter(F.from_json("line", DOCUMENT, {"mode": "PERMISSIVE"})["type"].isNull()).select("file")
    by_line = lines.join(split, "file", "left_anti").select("value")
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return by_line.unionByName(whole.join(split, "file", "left_semi").select("value"))


def unread_documents(documents: DataFrame) -> DataFrame:
    """(n_documents, n_unread): how many there are, and how many are no feature, collection or geometry."""
    kind = F.from_json("value", DOCUMENT)["type"]
    known = F.coalesce(kind.isin("Feature", "FeatureCollection", *GEOMETRIES), F.lit(False))
    return documents.filter("trim(value) <> ''").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(~known).alias("n_unread"))


def parse_features(lines: DataFrame) -> DataFrame:
    """Points, lines and polygons, single or multiple: each point, line or ring is a part. A collection of geometries gives a
    row for each of them, a collection of features the rows of its features, a bare geometry rows without properties."""
    d = lines.select(F.from_json("value", DOCUMENT).alias("d"))
    feature = F.struct(F.col("d.properties").alias("properties"), F.col("d.geometry").alias("geometry"))
    bare = F.struct(F.lit(None).cast("map<string,string>").alias("properties"), F.struct(F.col("d.type").alias("type"), F.col("d.coordinates").alias("coordinates"), F.col("d.geometries").alias("geometries")).alias("geometry"))
    each = F.when(F.col("d.type") == "FeatureCollection", F.col("d.features")).when(F.col("d.type").isin(*GEOMETRIES), F.array(bare)).otherwise(F.array(feature))
    f = d.select(F.explode(each.cast(f"array<{ONE}>")).alias("f")).filter("f.geometry IS NOT NULL")
    own = F.array(F.struct(F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("coordinates")))
    each = F.when(F.col("f.geometry.type") == "GeometryCollection", F.col("f.geometry.geometries")).otherwise(own)
    g = f.select(F.col("f.properties").alias("properties"), F.explode(each).alias("g"))
    read = lambda depth: F.from_json("g.coordinates", "array<" * depth + "double" + ">" * depth)
    rings = (
        F.when(F.col("g.type") == "Point", F.array(F.array(read(1))))
        .when(F.col("g.type") == "MultiPoint", F.transform(read(2), lambda v: F.array(v)))
        .when(F.col("g.type") == "LineString", F.array(read(2)))
        .when(F.col("g.type").isin("Polygon", "MultiLineString"), read(3))
        .when(F.col("g.type") == "MultiPolygon", F.flatten(read(4)))
    )
    placed = F.transform(rings, lambda r: F.transform(r, lambda v: F.struct(F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("y"))))
    return g.select("properties", F.col("g.type").alias("geom_type"), placed.alias("rings"))


def vertices(features: DataFrame) -> DataFrame:
    """A row for each vertex of each part."""
    parts = features.select("*", F.posexplode("rings").alias("part", "ring")).drop("rings")
    return parts.select("*", F.posexplode("ring").alias("vertex", "v")).select(*[c for c in parts.columns if c != "ring"], "vertex", F.col("v.x").alias("x"), F.col("v.y").alias("y"))


def layer_info(features: DataFrame, layer: str = "layer") -> DataFrame:
    """A row for each layer: layer, n_features, geometry types in order, n_vertices, and the extent min_x, min_y, max_x, max_y.

    One pass with partial sums; features without vertices count, and a layer of only such has a null extent."""
    points = F.flatten("rings")
    end = lambda inner, outer, c: outer(inner(F.transform(points, lambda v: v[c])))
    extent = [end(inner, outer, c).alias(f"{name}_{c}") for name, inner, outer in (("min", F.array_min, F.min), ("max", F.array_max, F.max)) for c in "xy"]
    count = F.coalesce(F.sum(F.size(F.coalesce(points, F.array().cast("array<struct<x:double,y:double>>")))), F.lit(0)).cast("long")
    return features.groupBy(layer).agg(F.count(F.lit(1)).alias("n_features"), F.sort_array(F.collect_set("geom_type")).alias("geom_types"), count.alias("n_vertices"), *extent)


def layer(spark: SparkSession, layers: dict[str, DataFrame], query: str | None = None, name: str | None = None, index: int | None = None) -> DataFrame:
    """A layer: what a query over the layers gives, else the named one, else the one with an index."""
    if query is not None:
        return spark.sql(query, **layers)
    if name is not None:
        return layers[name]
    if index is None:
        raise ValueError("give a query, a name or an index")
    return list(layers.values())[index]
