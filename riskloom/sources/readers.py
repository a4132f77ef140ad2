"""Readers for posts, histories and earlier scores.

Whole documents of posts (one JSON array per file) are read in pieces that end at a
closing brace, so neither a task nor a row holds more than a block of a file, however
long it is. Whole documents of histories are read one file per task. JSON lines and
Parquet are the layouts for large data, and are what the jobs write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.text import empty_to_null
from riskloom.operators.users import fallback_scores
from riskloom.schemas import HISTORY, ITEM, POST, USERS
from riskloom.sources.staging import path_exists, staged

_LENIENT = T.StructType([T.StructField(n, T.StringType()) for n in [*POST.names, "selftext"]])


def _refused(what: str, file: Column | None = None) -> Column:
    """Fails with the file and the start of the text."""
    shown, file = F.left("value", F.lit(40)), F.input_file_name() if file is None else file
    return F.raise_error(F.concat(F.lit(f"{what} in "), file, F.lit(": "), shown))


def _checked(value: Column, sound: Column, what: str, file: Column | None = None) -> Column:
    return F.when(sound, value).otherwise(_refused(what, file))


def _is_json(value: Column | str = "value") -> Column:
    return F.try_parse_json(value).isNotNull()


def _elements(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """Raw JSON text of each post as ``value``; anything malformed fails."""
    if lines:
        found = spark.read.text(path).where(F.trim("value") != "")
        return found.select(_checked(F.col("value"), _is_json(), "malformed JSON").alias("value"))
    runs, file = _runs(staged(_pieces(spark, path), "pieces")), F.col("file")
    # Each run becomes an array of its own: without the bracket that closes the whole one, and
    # with an opening one in place of that of the whole one or of the comma before it.
    start = F.when(F.col("first"), r"^ *\[").otherwise(r"^[ \t\r\n]*,")
    end = F.when(F.col("last"), r"\][ \t\r\n]*$").otherwise("$")
    held = F.regexp_replace(F.regexp_replace("value", end, F.lit("")), start, F.lit(""))
    blank = F.trim(F.col("_held"), F.lit(" \t\r\n")) == ""
    array = F.concat(F.lit("["), "_held", F.lit("]"))
    # Blank is only an empty array, or what is left after the last object.
    whole = F.when(blank, F.col("last") & (F.col("first") | ~F.rlike("value", start)))
    whole = whole.otherwise(F.rlike("value", start) & _is_json(array))
    parsed = F.from_json(array, "array<string>", {"mode": "PERMISSIVE"})
    opened = ~F.col("first") | F.rlike("value", start)
    value = _checked(parsed, F.rlike("value", end) & whole, "malformed JSON", file)
    value = _checked(value, opened, "expected a JSON array", file)
    return runs.withColumn("_held", held).select(F.explode(value).alias("value"))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Texts up to each closing brace, placed in their files, and what they do to the nesting.

    ``outside`` is by how much a piece with its brace changes the depth if it starts outside
    of strings, ``inside`` if it starts in one, ``quotes`` whether it changes between the two.
    An escape never reaches over the end of a piece, as a brace can't be escaped.
    """
    marks = F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), r'[^"\[\]{}]', "")

    def depth(marks: Column) -> Column:
        bare = F.regexp_replace(marks, r'"[^"]*("|$)', "")
        return 2 * F.length(F.regexp_replace(bare, r"[\]}]", "")) - F.length(bare)

    quotes = F.length(F.regexp_replace("_marks", r'[^"]', "")) % 2
    return (
        spark.read.text(path, lineSep="}")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            "value",
            marks.alias("_marks"),
        )
        .withColumn("quotes", quotes)
        .withColumn("outside", depth(F.col("_marks")) - (1 - F.col("quotes")))
        .withColumn("inside", depth(F.concat(F.lit('"'), "_marks")) - F.col("quotes"))
        .drop("_marks")
    )


def _before(column: Column, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _runs(pieces: DataFrame) -> DataFrame:
    """(file, value, first, last): what each file holds, cut after each object in its array.

    Files are read in blocks. What a block does to the nesting is summed up first; from
    that follows how each one begins, and the blocks are cut independently.
    """
    block, in_block = ["file", "block"], Window.partitionBy("file", "block").orderBy("pos")
    in_file = Window.partitionBy("file").orderBy("block")
    bare = F.col("odd") == 0
    sums = (
        pieces.withColumn("odd", _before(F.col("quotes"), in_block) % 2)
        .groupBy(*block, "size")
        .agg(
            F.sum("quotes").alias("quotes"),
            F.sum(F.when(bare, F.col("outside")).otherwise(F.col("inside"))).alias("outside"),
            F.sum(F.when(bare, F.col("inside")).otherwise(F.col("outside"))).alias("inside"),
            F.max("pos").alias("end"),
            F.sum(F.octet_length("value") + 1).alias("bytes"),
        )
    )
    begun = sums.withColumn("odd", _before(F.col("quotes"), in_file) % 2).select(
        *block,
        F.col("odd").alias("_odd"),
        _before(F.when(bare, F.col("outside")).otherwise(F.col("inside")), in_file).alias("_depth"),
        F.when(F.lead("block").over(in_file).isNull(), F.col("end")).alias("_end"),
        # A file that ends with a brace has one for each piece.
        (F.sum("bytes").over(Window.partitionBy("file")) == F.col("size")).alias("_braces"),
    )
    begun = staged(begun, "begun")
    odd = (F.col("_odd") + _before(F.col("quotes"), in_block)) % 2
    depth = F.col("_depth") + F.sum(F.when(bare, F.col("outside")).otherwise(F.col("inside"))).over(
        in_block.rowsBetween(Window.unboundedPreceding, 0)
    )
    last = F.coalesce(F.col("pos") == F.col("_end"), F.lit(False))
    # An object of the array ends with a brace outside of strings that leaves only the array open.
    cut = ((F.col("odd") + F.col("quotes")) % 2 == 0) & (F.col("depth") == 1) & ~F.col("last")

    def placed(pieces: DataFrame) -> DataFrame:
        return (
            pieces.join(begun, block)
            .withColumns({"odd": odd, "last": last})
            .withColumn("depth", depth)
            .withColumn("cut", cut.cast("int"))
        )

    cuts = placed(pieces.drop("value")).groupBy(*block).agg(F.sum("cut").alias("cuts"))
    numbers = staged(cuts.select(*block, _before(F.col("cuts"), in_file).alias("_number")), "numbers")
    text = F.concat("value", F.when(F.col("last") & ~F.col("_braces"), "").otherwise("}"))
    parts = F.sort_array(F.collect_list(F.struct("block", "pos", text.alias("text"))))
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), "")
    return (
        placed(pieces)
        .withColumn("run", _before(F.col("cut"), in_block))
        .join(numbers, block)
        .groupBy("file", (F.col("_number") + F.col("run")).alias("run"))
        .agg(joined.alias("value"), F.max("last").alias("last"))
        .select("file", "run", "value", (F.col("run") == 0).alias("first"), "last")
        .sortWithinPartitions("file", "run")
    )


def read_posts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Posts with missing or empty fields defaulted.

    Elements that are no objects are skipped; ``text`` falls back to
    ``selftext``; ids become text; a missing time is 0.
    """
    elements = _elements(spark, path, lines).where(F.ltrim("value").startswith("{"))
    fields = elements.select(F.from_json("value", _LENIENT).alias("p")).select("p.*")

    def filled(*names: str) -> Column:
        return F.coalesce(*(empty_to_null(F.col(n)) for n in names), F.lit(""))

    columns = {n: filled(n) for n in POST.names}
    columns["text"] = filled("text", "selftext")
    columns["created_utc"] = F.coalesce(F.col("created_utc").try_cast("double"), F.lit(0.0))
    columns["language"] = F.col("language")
    return fields.select(*(c.alias(n) for n, c in columns.items()))


def read_posts_strict(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Posts whose fields must be exactly the model's; ``language`` may lack.

    Fields are compared in the same pass that reads them; a post with other
    fields fails the read.
    """
    elements = _elements(spark, path, lines)
    fields = F.json_object_keys("value")
    known = F.array(*map(F.lit, POST.names))
    required = F.array(*(F.lit(n) for n in POST.names if n != "language"))
    odd = F.array_except(fields, known)
    lacking = F.array_except(required, fields)
    named = F.concat(
        F.lit("unknown fields ["), F.array_join(odd, ", "),
        F.lit("], missing fields ["), F.array_join(lacking, ", "), F.lit("]"),
    )
    sound = fields.isNotNull() & (F.size(odd) == 0) & (F.size(lacking) == 0)
    post = F.from_json("value", POST, {"mode": "FAILFAST"})
    checked = F.when(sound, post).otherwise(
        F.raise_error(F.coalesce(named, F.lit("a post is not an object")))
    )
    posts = elements.select(checked.alias("p")).select("p.*")
    whole = F.array(*(F.col(n).isNotNull() for n in POST.names if n != "language"))
    # Checked on the time, which no reader of posts can do without.
    created = F.when(F.forall(whole, lambda v: v), F.col("created_utc")).otherwise(
        F.raise_error(F.lit("a post lacks a required field"))
    )
    return posts.withColumn("created_utc", created)


def read_history(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(users, items) of a ``{username: [item, ...]}`` document (S3).

    Items lacking a field are dropped, their users kept; an absent file is an
    empty history. A field that is JSON null counts as lacking.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], USERS), spark.createDataFrame([], HISTORY)
    documents = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", T.MapType(T.StringType(), T.ArrayType(ITEM)))
    sound = _is_json() & F.ltrim("value").startswith("{")
    entries = documents.select(
        F.explode(_checked(parsed, sound, "expected a JSON object")).alias("username", "items")
    )
    users = entries.select("username")
    items = entries.select("username", F.explode("items").alias("i")).select("username", "i.*")
    return users, items.dropna(subset=ITEM.names)


def read_history_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(users, items) of the flat layout written by ``write_history`` (S3)."""
    if not path_exists(spark, f"{path}/users"):
        return spark.createDataFrame([], USERS), spark.createDataFrame([], HISTORY)
    users = spark.read.schema(USERS).parquet(f"{path}/users")
    items = spark.read.schema(HISTORY).parquet(f"{path}/items")
    return users, items.dropna(subset=ITEM.names)


def read_history_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(users, items) of the nested JSON lines written by ``write_history_nested`` (S3)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], USERS), spark.createDataFrame([], HISTORY)
    line = T.StructType([*USERS.fields, T.StructField("items", T.ArrayType(ITEM))])
    lines = spark.read.schema(line).json(path, mode="FAILFAST")
    items = lines.select("username", F.explode("items").alias("i")).select("username", "i.*")
    return lines.select("username").distinct(), items.dropna(subset=ITEM.names)


def read_fallback_scores(
    spark: SparkSession, path: str, score: str = "risk_score"
) -> DataFrame:
    """(author, score) of a scored-post CSV; absent file is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "author string, score double")
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return fallback_scores(rows, score)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the model's shape: required columns checked, cast, ordered.

    Any function returning such a DataFrame can serve as a source.
    """
    missing = [n for n in schema.names if n not in df.columns and n != "language"]
    if missing:
        raise ValueError(f"source lacks columns: {missing}")
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
