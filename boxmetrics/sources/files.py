"""Reading tables and writing a new version of one beside the old."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boxmetrics.functions import numbers as nb
from boxmetrics.operators.tables import merge_latest

#: Words of laid-out pages, the boundary to whatever reads the documents themselves.
WORDS = "doc_id string, page int, pos int, x0 double, top double, text string"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_rows(spark: SparkSession, path: str, schema: StructType, kind: str = "csv", **options: str) -> DataFrame:
    """CSV or JSON lines under a declared schema; broken lines go to ``_corrupt_record`` if the schema names it."""
    return spark.read.format(kind).options(**options).schema(schema).load(path)


def read_documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Whole files as rows: path, length, modification time, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def with_signature(documents: DataFrame, signature: bytes = b"%PDF-") -> DataFrame:
    """``documents`` (path, content, ...) with ``valid``: whether the content begins with the signature."""
    head = F.col("content").substr(1, len(signature))
    return documents.withColumn("valid", F.coalesce(head == F.lit(bytearray(signature)), F.lit(False)))


def file_stem(path: Column) -> Column:
    """The file's name without its folder and last ending."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def read_pages(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """Whole pages as rows (stem, html); bytes that are no UTF-8 are replaced."""
    found = read_documents(spark, path, pattern)
    return found.select(file_stem(F.col("path")).alias("stem"), F.col("content").cast("string").alias("html"))


def pair_manifests(pages: DataFrame, manifests: DataFrame, id_in_url: Column, id_in_page: Column) -> DataFrame:
    """Pages (stem, html) with the manifest (stem, url) of the same stem, and their id: that of the address, else that in the page."""
    return pages.join(manifests, "stem", "left").withColumn("id", F.coalesce(F.nullif(id_in_url, F.lit("")), F.nullif(id_in_page, F.lit(""))))


def read_grants(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Grants of a CSV by semicolons with decimal commas: (good rows, bad lines).

    A blank number is null; one that cannot be read makes the whole line bad.
    """
    fields = ["title", "amount", "budget", "kind", "year"]
    schema = ", ".join(f"{f} string" for f in fields) + ", _bad string"
    raw = spark.read.csv(path, sep=";", header=True, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    amount, budget = nb.parse_decimal(F.col("amount")), nb.parse_decimal(F.col("budget"))
    year = F.trim("year").try_cast("int")
    bad = F.col("_bad").isNotNull() | (~blank("amount") & amount.isNull()) | (~blank("budget") & budget.isNull()) | (~blank("year") & year.isNull())
    marked = raw.withColumn("_is_bad", bad)
    good = marked.where("NOT _is_bad").select(F.trim("title").alias("title"), amount.alias("amount"), budget.alias("budget"), F.trim("kind").alias("kind"), year.alias("year"))
    lines = F.coalesce("_bad", F.concat_ws(";", *fields))
    return good, marked.where("_is_bad").select(lines.alias("line"))


def read_series(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    """A yearly series by the place of its columns, whatever its header calls them: (year, names...); rows without a year go, blanks are null."""
    schema = "year string, " + ", ".join(f"`{n}` string" for n in names)
    raw = spark.read.csv(path, sep=sep, header=True, schema=schema, enforceSchema=True)
    return raw.select(F.trim("year").try_cast("int").alias("year"), *[nb.parse_decimal(F.col(n)).alias(n) for n in names]).where("year IS NOT NULL")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Whole numbers of a file with a header and one id a line, as (id, place): each once, placed by its first line.

    A byte order mark, blank lines and what is no number are passed over.
    """
    # one whole file a row, so that lines keep their order
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("place", "line")).where("place > 0")
    ids = lines.select(F.trim(F.regexp_replace(F.split("line", ",")[0], '^\ufeff|"', "")).try_cast("long").alias("id"), "place")
    return ids.where("id IS NOT NULL").groupBy("id").agg(F.min("place").alias("place"))


# Headers under which a title, or a release day, may stand.
TITLE_HEADERS, DAY_HEADERS = ("titulo_normalizado", "titulo", "titulo_anual_esp"), ("fecha_estreno", "fecha")


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """(released, title) of a list by tabs or commas, with a header or without, its columns in either order.

    The first line says how the list is written; a day that is no date raises.
    """
    first = spark.read.text(path).first()
    if first is None:
        return spark.createDataFrame([], "released date, title string")
    line = first[0].lstrip("\ufeff")
    sep = "\t" if "\t" in line else ","
    cells = [c.strip().strip('"').lower().replace(" ", "_") for c in line.split(sep)]
    header = any(c in (*TITLE_HEADERS, *DAY_HEADERS) for c in cells)
    if header:
        at = lambda names: next(cells.index(n) for n in names if n in cells)
        title, day = at(TITLE_HEADERS), at(DAY_HEADERS)
    else:
        title, day = (1, 0) if cells[0][:4].isdigit() and cells[0][4:5] == "-" else (0, 1)
    raw = spark.read.csv(path, sep=sep, header=header, schema=", ".join(f"c{i} string" for i in range(len(cells))))
    rows = raw.select(F.trim(f"c{day}").alias("day"), F.trim(f"c{title}").alias("title")).where("coalesce(day, '') <> '' AND coalesce(title, '') <> ''")
    return rows.select(F.col("day").cast("date").alias("released"), "title")


def write_rows(df: DataFrame, path: str, columns: list[str], kind: str = "csv") -> None:
    """CSV, TSV or JSON lines with just these columns in this order; a missing one is empty, others are left out."""
    have = set(df.columns)
    out = df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])
    if kind == "json":
        out.write.mode("overwrite").json(path)
    else:
        out.write.mode("overwrite").csv(path, header=True, sep="\t" if kind == "tsv" else ",")


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table; the files of one call appear together."""
    df.write.mode("append").parquet(path)


class VersionedTable:
    """A table in parts by the hash of its keys, whose versions name for each part the files that hold it.

    A version is there when its list is: data comes first, the list last, so that a
    reader sees the old version until the new one is whole, and for good if its
    writer fails. A change writes the parts anew that its keys fall into; all
    others stay the files that they are. The number of parts is fixed by the first
    version. Rows with null keys have a part as any others.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], parts: int = 64) -> None:
        self.spark, self.path, self.keys, self.parts = spark, path, keys, parts

    def _part(self, df: DataFrame) -> DataFrame:
        return df.withColumn("part", F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def lists(self) -> DataFrame:
        """All versions: (version, part, folder, schema)."""
        return self.spark.read.schema("part int, folder string, schema string, version long").parquet(f"{self.path}/lists")

    def version(self) -> int:
        """The newest whole version; 0 before the first."""
        try:
            return self.lists().agg(F.max("version")).first()[0] or 0
        except AnalysisException:  # no list has been written yet
            return 0

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The rows of a version, by default the newest whole one; ``only`` some parts of it."""
        version = version or self.version()
        found = self.lists().where(F.col("version") == version).collect() if version else []  # one row a part
        if not found:
            raise LookupError(f"no version {version} of {self.path}")
        folders = [r.folder for r in found if r.folder and (only is None or r.part in only)]
        schema = StructType.fromJson(json.loads(found[0].schema))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _publish(self, rows: DataFrame, schema: StructType, touched: list[int]) -> int:
        old, number = self.version(), self.version() + 1
        folder = f"{self.path}/data/version={number}"
        self._part(rows).repartition("part").write.mode("overwrite").partitionBy("part").parquet(folder)
        written = {r.part for r in self.spark.read.schema("part int").parquet(folder).select("part").distinct().collect()}
        kept = {r.part: r.folder for r in self.lists().where(F.col("version") == old).collect()} if old else {}
        kept |= {p: f"{folder}/part={p}" if p in written else "" for p in touched}
        listed = [(p, kept.get(p, ""), schema.json()) for p in range(self.parts)]
        self.spark.createDataFrame(listed, "part int, folder string, schema string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/lists/version={number}")
        return number

    def replace(self, rows: DataFrame) -> int:
        """A version of just these rows."""
        return self._publish(rows, rows.schema, list(range(self.parts)))

    def touched(self, rows: DataFrame) -> list[int]:
        return sorted(r.part for r in self._part(rows.select(*self.keys)).select("part").distinct().collect())

    def upsert(self, updates: DataFrame, merge=merge_latest) -> int:
        """A version with the updates merged in (by default each replaces the rows of its key); only their parts are read and written."""
        parts = self.touched(updates)
        base = self.read(only=parts)
        return self._publish(merge(base, updates, self.keys), base.schema, parts)

    def refresh(self, source: DataFrame, build, changed: DataFrame) -> int:
        """A derived table brought up to date where keys have changed: ``build`` makes its rows from the source rows of their parts.

        ``changed`` holds the keys; ``build`` must make a row from source rows of its own key.
        """
        parts = self.touched(changed)
        some = self._part(source).where(F.col("part").isin(parts)).drop("part")
        rows = build(some)
        return self._publish(rows, rows.schema, parts)


def write_version(df: DataFrame, path: str, version: int, partition_by: tuple[str, ...] = ()) -> str:
    """Write one version of a table; writing it again after a failure replaces it whole."""
    target = f"{path}/version={version}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    return target


def fill_missing(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Nulls of the named columns become the given marks."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
