"""Reading and writing tables of elements and features (S-01 .. S-14)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENT = "osm_type string, osm_id bigint, tags map<string,string>, node_ids array<bigint>, is_area boolean"
# fixed values: keys that make a way relevant
RELEVANT = ["highway", "parking:left", "parking:right", "parking:both", "amenity", "leisure", "obstacle:parking", "traffic_calming"]


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """S-01: elements from Parquet or JSON lines; tags given as JSON text become a map."""
    df = spark.read.json(path, schema=ELEMENT.replace("map<string,string>", "string")) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)
    if isinstance(df.schema["tags"].dataType, T.StringType):
        df = df.withColumn("tags", F.from_json("tags", "map<string,string>"))
    return df


def layer_schema(layer: str, kind: str, columns: Sequence[str], types: dict[str, str], text: Sequence[str] = ()) -> tuple[str, T.StructType]:
    """S-02: the name and schema of a layer table; columns are text unless `types` says otherwise, and those in `text` stay text."""
    names = {"integer": T.IntegerType(), "real": T.FloatType(), "text": T.StringType()}
    geom = {"node": "struct<x:double,y:double>", "way": "array<struct<x:double,y:double>>", "polygon": "array<array<struct<x:double,y:double>>>"}[kind]
    fields = [T.StructField("osm_id", T.LongType())] + [T.StructField(c, names["text" if c in text else types.get(c, "text")]) for c in columns]
    shape = T.StructType.fromDDL(f"geom {geom}")
    return f"{layer}_{kind}", T.StructType([*fields, *shape.fields])


def relevant_ways(df: DataFrame) -> DataFrame:
    """S-03."""
    any_key = F.lit(False)
    for k in RELEVANT:
        any_key = any_key | F.map_contains_key("tags", k)
    return df.where(any_key)


def exclude_hidden(df: DataFrame) -> DataFrame:
    """S-04: without what lies underground or indoors."""
    under = F.coalesce(F.col("tags")["location"].isin("underground", "indoor"), F.lit(False))
    return df.where(~under & ~F.coalesce(F.col("tags")["indoor"] != "no", F.lit(False)))


def within_bbox(df: DataFrame, bbox: Sequence[float], x: str = "x", y: str = "y") -> DataFrame:
    """S-05: rows inside (west, south, east, north); a box that is not one is an error."""
    west, south, east, north = map(float, bbox)
    if not (-180 <= west < east <= 180 and -90 <= south < north <= 90):
        raise ValueError(f"not a bounding box: {bbox}")
    return df.where(F.col(x).between(west, east) & F.col(y).between(south, north))


def feature_lines(df: DataFrame, key: str, properties: Sequence[str]) -> DataFrame:
    """S-07: (key, line): a GeoJSON point feature per row with x and y."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates"))
    line = F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")))
    return df.select(key, line.alias("line"))


def write_geojson(df: DataFrame, key: str, properties: Sequence[str], path: str) -> DataFrame:
    """S-07: writes features as lines ordered by key, and returns (n, digest): their count and a SHA-256 that tells two sets of lines apart.

    The digest is not that of the file's bytes: it is taken over the sums of the four words of all lines' own SHA-256,
    so it needs no order, and tasks hand on four numbers.
    """
    lines = feature_lines(df, key, properties)
    lines.orderBy(key).select("line").write.text(path)
    word = lambda i: F.conv(F.substring(F.sha2("line", 256), 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")
    sums = lines.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(word(i)), F.lit(0)).cast("string").alias(f"w{i}") for i in range(4)])
    return sums.select("n", F.sha2(F.concat_ws("|", F.col("n").cast("string"), "w0", "w1", "w2", "w3"), 256).alias("digest"))


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """S-08: writes an input once; later runs start from what was written first."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replace_by_source(target: DataFrame, new: DataFrame, sources: Sequence[str]) -> DataFrame:
    """S-09: the target without the rows of these sources (null stays), and the new rows."""
    return target.where(F.coalesce(~F.col("source").isin(list(sources)), F.lit(True))).unionByName(new, allowMissingColumns=True)


def with_geom(df: DataFrame, geom: Column) -> DataFrame:
    """S-10: all columns with another geometry."""
    return df.withColumn("geom", geom)


def run_stage(spark: SparkSession, ledger: str, name: str, run_id: str, make: Callable[[], DataFrame], path: str) -> DataFrame:
    """S-11: writes a stage's table once per run id and notes its rows; a stage that is in the ledger is read, not made."""
    done = None
    try:
        done = spark.read.parquet(ledger).where((F.col("stage") == name) & (F.col("run_id") == run_id)).limit(1).collect()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
    if not done:
        df = make()
        df.write.mode("overwrite").parquet(path)
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), F.lit(run_id).alias("run_id"), "rows", F.current_timestamp().alias("at")).write.mode("append").parquet(ledger)
    return spark.read.parquet(path)


def empty_like(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """S-12."""
    return spark.createDataFrame([], schema)


def publish(df: DataFrame, properties: dict[str, str]) -> DataFrame:
    """S-13: the columns that a layer shows, as their types."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in properties.items()])


def combined_extent(*tables: DataFrame) -> DataFrame:
    """S-14: (xmin, ymin, xmax, ymax) over tables with x and y."""
    out = None
    for df in tables:
        one = df.agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))
        out = one if out is None else out.unionByName(one)
    return out.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
