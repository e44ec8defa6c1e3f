"""JSON line files: scanning, the source named by the path, good and broken lines."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda import presets
from vereda.functions.conversion import source_from_path

SUFFIXES = ("jsonl", "txt")
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def file_glob(suffix=SUFFIXES) -> str:
    endings = [suffix] if isinstance(suffix, str) else list(suffix)
    return "*.{" + ",".join(ending.lstrip(".") for ending in endings) + "}"


def _has_files(spark, root, glob):
    """Whether a file below ``root`` matches; the listing is read up to the first that does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    wanted = spark._jvm.org.apache.hadoop.fs.GlobFilter(glob)
    entries = system.listFiles(path, True)
    while entries.hasNext():
        found = entries.next().getPath()
        if wanted.accept(found) and not found.getName().startswith(("_", ".")):
            return True
    return False


def lines_of(spark: SparkSession, text: DataFrame, root: str) -> DataFrame:
    """``arquivo, fonte, linha`` of the lines of a text scan or stream of files below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = path.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri().getPath()
    # File paths come as URIs: without the scheme and host, and unescaped, they begin with the root.
    escaped = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    whole = F.url_decode(F.regexp_replace(escaped, r"\+", "%2B"))
    below = F.substring("_path", len(folder.rstrip("/")) + 2, 1 << 30)
    return text.select("value", whole.alias("_path")).filter(F.col("value") != "").select(
        below.alias("arquivo"),
        source_from_path(below).alias("fonte"),
        F.col("value").alias("linha"),
    )


def scan_jsonl(spark: SparkSession, root: str, suffix=SUFFIXES) -> DataFrame:
    """One row per non-empty line of every file below ``root`` with one of the suffixes.

    ``arquivo`` is the path below the root and ``fonte`` the source it names. The sink's own
    files end in ``.txt``. A root without matching files is an error.
    """
    glob = file_glob(suffix)
    text = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(root)
    )
    if not _has_files(spark, root, glob):
        raise FileNotFoundError(f"no {glob} below {root}")
    return lines_of(spark, text, root)


def tag_lines(lines: DataFrame, fields=presets.KEY_FIELDS) -> DataFrame:
    """The named text fields of every line, and whether the line is one JSON object.

    A parser stops where the first value ends. So the line is put into a list, and the list into
    an object whose second key is the digest of the line: that key is there, alone beside the
    list, and the list has one element exactly when the line is a single value. To end the
    wrapping early or to add to it, a line would have to hold its own digest. Lines that are not
    whole have no fields. The line is parsed once.
    """
    digest = F.md5("linha")
    record = ", ".join(f"{name}: string" for name in fields)
    wrapped = F.concat(F.lit('{"linha":['), "linha", F.lit('],"'), digest, F.lit('":[]}'))
    parsed = F.from_json(wrapped, f"map<string, array<struct<{record}>>>", _STRICT)
    # A generated column: a filter on it cannot make Spark parse the line again.
    held = lines.select("*", F.inline(F.array(F.struct(
        parsed.alias("_partes"), F.array(F.lit("linha"), digest).alias("_chaves")
    ))))
    listed = F.get(F.map_values("_partes"), F.lit(0))
    found = F.get(listed, F.lit(0))
    whole = F.coalesce(
        (F.map_keys("_partes") == F.col("_chaves")) & (F.size(listed) == 1) & found.isNotNull()
        & F.rtrim("linha").endswith("}"), F.lit(False),
    )
    return held.withColumns({"_achado": F.when(whole, found), "inteira": whole}).select(
        *lines.columns, *[F.col("_achado")[name].alias(name) for name in fields], "inteira"
    )


def parse_lines(lines: DataFrame, fields=presets.KEY_FIELDS):
    """Good lines with the named text fields read from them, and lines that are no object."""
    tagged = tag_lines(lines, fields)
    kept = tagged.filter("inteira").drop("inteira")
    return kept, tagged.filter("NOT inteira").select(*lines.columns)
