"""Queries over texts, archives and file listings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t
from ..sources.archives import WRITTEN, read_zip_csv, write_zip_csv
from ..sources.image_files import file_catalog
from ..session import scratch_path
from ..sources.tables import read_csv, table
from .registry import query


def _words_sql() -> str:
    pairs = t.contraction_words().items()

    def quoted(v: str) -> str:
        return "'" + v.replace("'", "''") + "'"

    return f"""MAP {{{', '.join(f'{quoted(a)}: {quoted(b)}' for a, b in pairs)}}}"""


def _sql_text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _expanded_sql(x: str) -> str:
    full = f"{_words_sql()}[lower(replace({x}, chr(8217), chr(39)))]"
    return (
        f"coalesce(CASE WHEN length({x}) > 1 AND {x} = upper({x}) THEN upper({full}) "
        f"WHEN {x}[1] = upper({x}[1]) THEN upper({full}[1]) || {full}[2:] ELSE {full} END, {x})"
    )


_PUNCTUATION = "'" + t.PUNCTUATION.replace("'", "''") + "'"


def _clean_sql(text: str) -> str:
    bare = f"translate(lower(regexp_replace({text}, '<.*?>', '', 'g')), {_PUNCTUATION}, '')"
    tokens = f"regexp_extract_all({bare}, '\\s+|\\S+')"
    return f"array_to_string(list_transform({tokens}, lambda x: coalesce({_words_sql()}[x], x)), '')"


@query("clean_text", f"""SELECT 'page' AS kind, page_id AS id, {_clean_sql('html')} AS cleaned FROM pages
  UNION ALL SELECT 'document', doc_id, {_clean_sql('text')} FROM documents""")
def clean_text(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), t.clean_text("html").alias("cleaned"))
    documents = table(spark, folder, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), t.clean_text("text").alias("cleaned"))
    return pages.unionByName(documents)


@query("clean_text_steps", f"""SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS no_tags,
  lower(html) AS lowered, translate(html, {_PUNCTUATION}, '') AS no_marks FROM pages""")
def clean_text_steps(spark, folder):
    """Each step switched on alone."""
    off = {"remove_html_tags": False, "lowercase_text": False, "remove_punctuation": False, "expand": False}
    return table(spark, folder, "pages").select(
        "page_id",
        t.clean_text("html", **{**off, "remove_html_tags": True}).alias("no_tags"),
        t.clean_text("html", **{**off, "lowercase_text": True}).alias("lowered"),
        t.clean_text("html", **{**off, "remove_punctuation": True}).alias("no_marks"))


@query("labelled_clean_text", f"""SELECT doc_id, {_clean_sql('text')} AS review, quality AS sentiment
  FROM documents JOIN labels USING (doc_id)""")
def labelled_clean_text(spark, folder):
    """Cleaned text next to its label, on the same row."""
    labels = table(spark, folder, "labels")
    return table(spark, folder, "documents").join(labels, "doc_id").select(
        "doc_id", t.clean_text("text").alias("review"), F.col("quality").alias("sentiment"))


# Planted before and after each whole text, with what they become.
_BEFORE = ("Don\u2019t stop; we're \"it's\" DON'T. ", "Do not stop; we are \"it is\" DO NOT. ")
_AFTER = (" She'll say they've won't've, can't", " She will say they have won't've, cannot")


@query("expand_contractions", f"""SELECT doc_id, coalesce({_sql_text(_BEFORE[1])} || array_to_string(list_transform(
    regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+([''\u2019][\\p{{L}}\\p{{N}}_]+)*|[^\\p{{L}}\\p{{N}}_]+'), lambda x: {_expanded_sql('x')}), '')
  || {_sql_text(_AFTER[1])}, NULL) AS expanded FROM documents""")
def expand_contractions(spark, folder):
    """Contractions of whole texts, and some planted beside marks, in capitals and with either apostrophe."""
    line = F.concat(F.lit(_BEFORE[0]), F.col("text"), F.lit(_AFTER[0]))
    return table(spark, folder, "documents").select("doc_id", t.expand_contractions(line).alias("expanded"))


_DOCUMENT_CSV = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType()),
])


@query("scan_zip_csv", "SELECT doc_id, lang, n_chars, nullif(text, '') AS text FROM documents")
def scan_zip_csv(spark, folder):
    """The documents packed into zipped CSV files and read back from them."""
    documents = table(spark, folder, "documents").select(*_DOCUMENT_CSV.names)
    path = scratch_path(spark, "zips")
    write_zip_csv(documents, path)
    return read_zip_csv(spark, path, _DOCUMENT_CSV, WRITTEN).select(*_DOCUMENT_CSV.names)


@query("scan_csv_multiline", "SELECT doc_id, lang, n_chars, nullif(text, '') AS text FROM documents")
def scan_csv_multiline(spark, folder):
    """The documents, whose texts hold line feeds and quotes, through quoted CSV read by splits."""
    path = scratch_path(spark, "documents_csv")
    documents = table(spark, folder, "documents").select(*_DOCUMENT_CSV.names)
    documents.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return read_csv(spark, path, _DOCUMENT_CSV)


_IMAGE = """CASE p_partkey % 4 WHEN 0 THEN 'BRATS_' || p_partkey || '.nii.gz' WHEN 1 THEN '._BRATS_' || p_partkey || '.nii.gz'
  WHEN 2 THEN 'BRATS_' || p_partkey || '.txt' ELSE 'BRATS_' || p_partkey || '_t1.nii' END"""


@query("file_catalog", f"""WITH f AS (SELECT p_partkey AS k, {_IMAGE} AS name, CAST(p_size AS BIGINT) AS length FROM part)
  SELECT CAST(k AS VARCHAR) AS id, name, '/task/imagesTr/' || name AS image_path, length,
    CASE WHEN k % 3 = 0 THEN '/task/labelsTr/' || name END AS label_path
  FROM f WHERE k % 4 IN (0, 3)""")
def file_catalog_query(spark, folder):
    """Catalogue of a listing derived from the parts; a third of the images has labels."""
    key = F.col("p_partkey")
    text = key.cast("string")
    name = (
        F.when(key % 4 == 0, F.concat(F.lit("BRATS_"), text, F.lit(".nii.gz")))
        .when(key % 4 == 1, F.concat(F.lit("._BRATS_"), text, F.lit(".nii.gz")))
        .when(key % 4 == 2, F.concat(F.lit("BRATS_"), text, F.lit(".txt")))
        .otherwise(F.concat(F.lit("BRATS_"), text, F.lit("_t1.nii")))
    )
    files = table(spark, folder, "part").select(
        "p_partkey", name.alias("name"), F.col("p_size").cast("long").alias("length"))
    images = files.select(F.concat(F.lit("/task/imagesTr/"), F.col("name")).alias("path"), "length")
    labels = files.where(key % 3 == 0).select(F.concat(F.lit("/task/labelsTr/"), F.col("name")).alias("path"))
    return file_catalog(images, labels)
