"""Label files of text datasets as rows: image, index, value, class and box.

Every loader is a plan over Spark's file sources.  Boxes are
``xmin, ymin, xmax, ymax``; polygons, where kept, arrays of [x, y].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTS = "array<array<array<double>>>"
#: Classes of the artefact labels, in order (fixed values).
ARTEFACTS = ["background", "qr_code", "bar_code", "logo", "photo"]


def _whole(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file: ``file, j``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.input_file_name().alias("file"), F.from_json("value", schema).alias("j"))


def _map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """Entries of a JSON object keyed by image: ``image, label``."""
    return _whole(spark, path, f"map<string,{value}>").select(F.explode("j").alias("image", "label"))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def bounds(poly: Column) -> list[Column]:
    """Box of an array of [x, y]."""
    xs, ys = F.transform(poly, lambda p: p[0]), F.transform(poly, lambda p: p[1])
    return [F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")]


def corner_size(x: Column, y: Column, w: Column, h: Column) -> list[Column]:
    return [x.cast("double").alias("xmin"), y.cast("double").alias("ymin"), (x + w).cast("double").alias("xmax"), (y + h).cast("double").alias("ymax")]


def ocr_labels(spark: SparkSession, path: str) -> DataFrame:
    """``{image: {typed_words: [{value, geometry}]}}``; images without words keep one row without a word."""
    rows = _map(spark, path, "struct<typed_words:array<struct<value:string,geometry:array<double>>>>")
    w = rows.select("image", F.posexplode_outer("label.typed_words").alias("idx", "w"))
    return w.select("image", "idx", F.col("w.value").alias("value"), *(F.get("w.geometry", F.lit(i)).alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))))


def detection_labels(spark: SparkSession, path: str, default: str = "words") -> DataFrame:
    """``polygons`` is a list, of one class, or an object of class -> list; empty classes vanish."""
    rows = _map(spark, path, "struct<polygons:string>")
    one = F.from_json("label.polygons", POINTS)
    many = F.from_json("label.polygons", f"map<string,{POINTS}>")
    classes = F.when(F.ltrim("label.polygons").startswith("["), F.create_map(F.lit(default), one)).otherwise(many)
    c = rows.select("image", F.explode(classes).alias("class", "polygons"))
    return c.select("image", "class", F.posexplode("polygons").alias("idx", "polygon")).select("image", "class", "idx", "polygon", *bounds(F.col("polygon")))


def layout_labels(spark: SparkSession, path: str) -> DataFrame:
    """Parallel ``polygons`` and ``classes``; different lengths are an error."""
    rows = _map(spark, path, f"struct<polygons:{POINTS},classes:array<string>>")
    fits = F.size("label.polygons") == F.size("label.classes")
    pairs = F.when(fits, F.arrays_zip(F.col("label.polygons").alias("polygon"), F.col("label.classes").alias("class"))).otherwise(F.raise_error(F.concat(F.lit("polygons and classes differ in number: "), F.col("image"))))
    r = rows.select("image", F.posexplode(pairs).alias("idx", "r"))
    return r.select("image", "idx", F.col("r.class").alias("class"), *bounds(F.col("r.polygon")))


def table_labels(spark: SparkSession, path: str) -> DataFrame:
    """``cells`` and ``logic`` (first and last column, first and last row)."""
    rows = _map(spark, path, f"struct<cells:{POINTS},logic:array<array<int>>>")
    r = rows.select("image", F.posexplode(F.arrays_zip(F.col("label.cells").alias("cell"), F.col("label.logic").alias("logic"))).alias("idx", "r"))
    return r.select("image", "idx", *bounds(F.col("r.cell")), *(F.col("r.logic")[i].alias(n) for i, n in enumerate(("col_start", "col_end", "row_start", "row_end"))))


def recognition_labels(spark: SparkSession, path: str) -> DataFrame:
    return _map(spark, path, "string").select("image", F.col("label").alias("value"))


def merged(*sets: tuple[str, DataFrame]) -> DataFrame:
    """Datasets one after the other, image names made absolute by their folders; nothing is dropped."""
    out = None
    for folder, df in sets:
        one = df.withColumn("image", F.concat(F.lit(folder.rstrip("/") + "/"), "image"))
        out = one if out is None else out.unionByName(one)
    return out


def funsd_labels(spark: SparkSession, path: str, recognition: bool = False) -> DataFrame:
    """Words of forms; empty ones vanish; for recognition, words with check boxes go and the en dash becomes a hyphen."""
    rows = _whole(spark, path, "struct<form:array<struct<label:string,words:array<struct<box:array<int>,text:string>>>>>")
    w = rows.select(stem(F.col("file")).alias("image"), F.explode("j.form").alias("f")).select("image", F.col("f.label").alias("class"), F.explode("f.words").alias("w")).filter("w.text != ''")
    out = w.select("image", "class", F.col("w.text").alias("value"), *(F.col("w.box")[i].cast("double").alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))))
    return out.filter(~F.col("value").rlike("[☑☐]")).withColumn("value", F.translate("value", "–", "-")) if recognition else out


def cord_labels(spark: SparkSession, path: str) -> DataFrame:
    """Words of receipts from quads, cut at 0."""
    quad = ",".join(f"{a}{i}:int" for i in range(1, 5) for a in "xy")
    rows = _whole(spark, path, f"struct<valid_line:array<struct<words:array<struct<quad:struct<{quad}>,text:string>>,category:string>>>")
    w = rows.select(stem(F.col("file")).alias("image"), F.explode("j.valid_line").alias("l")).select("image", F.col("l.category").alias("class"), F.explode("l.words").alias("w")).filter("w.text != ''")
    side = lambda f, a: F.greatest(f(*(F.col(f"w.quad.{a}{i}") for i in range(1, 5))), F.lit(0)).cast("double")
    return w.select("image", "class", F.col("w.text").alias("value"), side(F.least, "x").alias("xmin"), side(F.least, "y").alias("ymin"), side(F.greatest, "x").alias("xmax"), side(F.greatest, "y").alias("ymax"))


def sroie_labels(spark: SparkSession, path: str) -> DataFrame:
    """Eight coordinates, then a text that may hold commas."""
    lines = spark.read.option("encoding", "ISO-8859-1").csv(path, sep="\x01", quote="").select(stem(F.input_file_name()).alias("image"), F.split("_c0", ",", 9).alias("p")).filter(F.size("p") == 9)
    n = [F.trim(F.col("p")[i]).cast("double") for i in range(8)]
    return lines.select("image", F.col("p")[8].alias("value"), F.least(*n[::2]).alias("xmin"), F.least(*n[1::2]).alias("ymin"), F.greatest(*n[::2]).alias("xmax"), F.greatest(*n[1::2]).alias("ymax"))


def ic13_labels(spark: SparkSession, path: str) -> DataFrame:
    """``gt_<image>.txt`` with four numbers and a quoted word a line."""
    p = F.split(F.regexp_replace("value", ",", " "), r"\s+", 5)
    lines = spark.read.text(path).select(F.regexp_replace(stem(F.input_file_name()), "^gt_", "").alias("image"), p.alias("p")).filter(F.size("p") == 5)
    return lines.select("image", F.regexp_replace(F.trim(F.col("p")[4]), r"^['\"]|['\"]$", "").alias("value"), *(F.col("p")[i].cast("double").alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))))


def tagged_rectangles(spark: SparkSession, path: str) -> DataFrame:
    """XML images with tagged rectangles; images without any vanish."""
    schema = "imageName string, taggedRectangles struct<taggedRectangle:array<struct<_x:double,_y:double,_width:double,_height:double,tag:string>>>"
    rows = spark.read.format("xml").option("rowTag", "image").schema(schema).load(path)
    r = rows.select(F.col("imageName").alias("image"), F.explode("taggedRectangles.taggedRectangle").alias("r"))
    return r.select("image", F.col("r.tag").alias("value"), *corner_size(F.col("r._x"), F.col("r._y"), F.col("r._width"), F.col("r._height")))


def imgur_labels(spark: SparkSession, path: str) -> DataFrame:
    """Three maps joined: images, their annotations, and the annotations' word and turned box; the word '.' goes."""
    schema = "struct<index_id:map<string,struct<image_url:string,image_path:string,image_hash:string>>,index_to_ann_map:map<string,array<string>>,ann_id:map<string,struct<word:string,bounding_box:string>>>"
    j = _whole(spark, path, schema)
    images = j.select(F.explode("j.index_id").alias("id", "i")).select("id", F.col("i.image_path").alias("image"))
    links = j.select(F.explode("j.index_to_ann_map").alias("id", "anns")).select("id", F.explode("anns").alias("ann"))
    anns = j.select(F.explode("j.ann_id").alias("ann", "a")).filter("a.word != '.'")
    b = F.from_json(F.col("a.bounding_box"), "array<double>")
    rows = images.join(links, "id").join(anns, "ann").select("image", F.col("a.word").alias("value"), b.alias("b"))
    c, s = F.cos(F.radians(F.col("b")[4])), F.sin(F.radians(F.col("b")[4]))
    w, h = (F.abs(F.col("b")[2] * c) + F.abs(F.col("b")[3] * s)) / 2, (F.abs(F.col("b")[2] * s) + F.abs(F.col("b")[3] * c)) / 2
    return rows.select("image", "value", (F.col("b")[0] - w).alias("xmin"), (F.col("b")[1] - h).alias("ymin"), (F.col("b")[0] + w).alias("xmax"), (F.col("b")[1] + h).alias("ymax"))


def coco_text_labels(spark: SparkSession, path: str, subset: str = "train") -> DataFrame:
    """Legible annotations of the images of a subset."""
    j = _whole(spark, path, "struct<imgs:map<string,struct<id:int,`set`:string,file_name:string>>,anns:map<string,struct<image_id:int,bbox:array<double>,utf8_string:string,legibility:string>>>")
    images = j.select(F.explode("j.imgs").alias("k", "i")).filter(F.col("i.set") == subset).select(F.col("i.id").alias("image_id"), F.col("i.file_name").alias("image"))
    anns = j.select(F.explode("j.anns").alias("k", "a")).filter("a.legibility = 'legible'").select("a.image_id", "a.bbox", F.col("a.utf8_string").alias("value"))
    b = F.col("bbox")
    return images.join(anns, "image_id").select("image", "value", *corner_size(b[0], b[1], b[2], b[3]))


def path_labels(spark: SparkSession, path: str, blacklist: DataFrame | None = None) -> DataFrame:
    """The label is the second part, at underscores, of a listed path; listed bad paths go."""
    rows = spark.read.text(path).select(F.trim("value").alias("image")).filter("image != ''")
    if blacklist is not None:
        rows = rows.join(blacklist.select(F.trim("value").alias("image")), "image", "left_anti")
    return rows.select("image", F.get(F.split(F.element_at(F.split("image", "/"), -1), "_"), F.lit(1)).alias("value"))


def listed_labels(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``path label ...``."""
    p = F.split("value", r"\s+")
    return spark.read.text(path).select(p[0].alias("image"), F.get(p, F.lit(1)).alias("value")).filter("value is not null")


def receipt_labels(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with boxes of eight values."""
    schema = "file_name string, height int, width int, annotations array<struct<box:array<double>,text:string,label:int>>"
    a = spark.read.schema(schema).json(path).select(F.col("file_name").alias("image"), F.posexplode("annotations").alias("idx", "a"))
    xs, ys = F.filter("a.box", lambda _, i: i % 2 == 0), F.filter("a.box", lambda _, i: i % 2 == 1)
    return a.select("image", "idx", F.col("a.text").alias("value"), F.col("a.label").alias("class"), F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def artefact_labels(spark: SparkSession, path: str, classes: list[str] = ARTEFACTS) -> DataFrame:
    """Boxes with the class as its position among the classes."""
    rows = _map(spark, path, "array<struct<geometry:array<double>,label:string>>")
    r = rows.select("image", F.posexplode("label").alias("idx", "r"))
    known = F.array(*map(F.lit, classes))
    return r.select("image", "idx", (F.array_position(known, F.col("r.label")) - 1).cast("int").alias("class"), *(F.col("r.geometry")[i].alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))))


def orientation_labels(spark: SparkSession, path: str) -> DataFrame:
    """All files of a folder with target 0."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("image"), F.lit(0).alias("target"))


def generated_words(spark: SparkSession, n: int, vocab: str, least: int, most: int, seed: int = 0) -> DataFrame:
    """``n`` words of ``least`` to ``most`` characters, the same for a seed on every cluster."""
    known = F.array(*map(F.lit, vocab))
    r = spark.range(n)
    length = F.lit(least) + F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(most - least + 1))
    pick = F.transform(F.sequence(F.lit(1).cast("long"), length.cast("long")), lambda i: F.element_at(known, (F.pmod(F.xxhash64(F.col("id"), i, F.lit(seed + 1)), F.lit(len(vocab))) + 1).cast("int")))
    return r.select("id", F.array_join(pick, "").alias("value"))


def positional_split(df: DataFrame, order: str, share: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """The first share of the rows in the order of a column, and the rest."""
    cut = df.agg(F.percentile_approx(F.col(order), share, 100000)).first()[0]
    return df.filter(F.col(order) <= cut), df.filter(F.col(order) > cut)
