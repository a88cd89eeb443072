"""Landed survey snapshots (O5-O7, O9).

Responses land below some root as
``<any folders>/<run timestamp>/<survey>/survey_responses.json``, one document per
survey (an array of responses, or an object with one under ``responses``) or further pages of it as
``survey_responses-<page>.json``, beside a
header-only ``survey_responses.csv`` that names the questions. Our own writer uses Spark's
partitioned layout (``process_timestamp=…/survey_id=…``, a response per
line) so that readers prune partitions; the readers accept both.

A response's fields are kept whole: the reader gives the response's JSON text
beside the answer map, the writer writes every column it is given. Answers become the text that
Python's ``str`` gives for the JSON value (``True``, ``['a', 'b']``, ``2.0``).
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.values import py_float_text
from varloom.sources.json_split import landed_responses

TS_FORMAT = "%Y%m%d %H%M%S"  # fixed value: run timestamp text
TS_PATTERN = "yyyyMMdd HHmmss"
JSON_NAME, CSV_NAME = "survey_responses.json", "survey_responses.csv"  # fixed values: landed file names
PAGE_NAME = "survey_responses-{}.json"  # of a survey's further documents
ROWS_PER_FILE = 200_000
PARTITIONED = "value string, process_timestamp string, survey_id string"


def process_timestamp(now: datetime | None = None) -> str:
    """The run timestamp stamped on every output of one run (O9)."""
    return (now or datetime.now()).strftime(TS_FORMAT)


def write_snapshot(responses: DataFrame, root: str, ts: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write responses as JSON, one folder per (run timestamp, survey) (O5).

    Every column is written. Dynamic partition overwrite (an option of this write, not of the
    session) replaces only the surveys written. A survey's rows are dealt to as many tasks as
    it has ``rows_per_file`` blocks, so a survey with a third of all rows is spread and a
    small one is one file.
    """
    blocks = responses.groupBy(F.col("survey_id").alias("__survey")).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("__blocks"))
    dealt = (responses.join(blocks, F.col("survey_id").eqNullSafe(F.col("__survey"))).drop("__survey")
             .withColumn("__block", F.pmod(F.xxhash64("response_id"), "__blocks")))
    (dealt.repartition("survey_id", "__block").drop("__blocks", "__block")
     .withColumnRenamed("response_id", "responseId").withColumn("process_timestamp", F.lit(ts))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 2 * rows_per_file)
     .option("ignoreNullFields", False).partitionBy("process_timestamp", "survey_id").json(root))


def landed_path(path: Column) -> tuple[Column, Column]:
    """(run timestamp, survey) of a landed file: its last two folders, with or without ``name=``."""
    folders = r"/(?:process_timestamp=)?([^/]+)/(?:survey_id=)?([^/]+)/[^/]+$"
    return F.regexp_extract(path, folders, 1), F.regexp_extract(path, folders, 2)


# str() of one JSON value whose text is `t` and whose typed form is the variant `v`.
_NUMBER = f"CASE WHEN t RLIKE '^-?[0-9]+$' THEN t ELSE {py_float_text('try_cast(t AS DOUBLE)')} END"
_SCALAR = ("CASE WHEN v IS NULL OR is_variant_null(v) THEN {null} WHEN schema_of_variant(v) = 'BOOLEAN' THEN if(t = 'true', 'True', 'False') "
           "WHEN schema_of_variant(v) = 'STRING' THEN {string} WHEN schema_of_variant(v) RLIKE '^(ARRAY|OBJECT)' THEN {nested} ELSE {number} END")
_QUOTED = ("if(contains(t, '\\'') AND NOT contains(t, '\"'), concat('\"', replace(t, '\\\\', '\\\\\\\\'), '\"'), "
           "concat('\\'', replace(replace(t, '\\\\', '\\\\\\\\'), '\\'', '\\\\\\''), '\\''))")
_ELEMENT = _SCALAR.format(null="'None'", string=_QUOTED, nested="t", number=_NUMBER)


# A JSON value's text that may not be its Python text: a fraction or exponent, a name, a list or an object, or a string that looks like one.
_UNLIKE = r"^(?:[\[{+.]|-(?![0-9]+$)|[0-9]+[^0-9]|(?:true|false|NaN|INF|Infinity)$)"


def _texts(response: str) -> Column:
    """The answer map of a response's JSON text with the values as they stand there, null for JSON null."""
    return F.expr(f"from_json({response}, '`values` map<string,string>').`values`")


def _answers(response: str, texts: str) -> Column:
    """The answer map of a response's JSON text: key -> Python text, null for JSON null. ``texts``: the column of ``_texts``.

    Only responses with a value whose kind decides its text, or with a repeated key, are read again with their kinds.
    """
    unlike = _UNLIKE.replace("\\", "\\\\")
    again = f"size(array_distinct(map_keys({texts}))) < size({texts}) OR exists(map_values({texts}), t -> t RLIKE '{unlike}')"
    typed = f"from_json({response}, '`values` map<string,variant>').`values`"
    items = f"transform(arrays_zip(from_json(t, 'array<string>'), CAST(v AS array<variant>)), e -> {_of_element()})"
    nested = f"CASE WHEN schema_of_variant(v) LIKE 'ARRAY%' THEN concat('[', array_join({items}, ', '), ']') ELSE t END"
    one = _SCALAR.format(null="CAST(NULL AS STRING)", string="t", nested=nested, number=_NUMBER)
    return F.expr(f"if({again}, map_zip_with({texts}, {typed}, (k, t, v) -> {one}), {texts})")


def _of_element() -> str:
    # the element's two parts are fields 0 and 1 of the zipped struct
    return re.sub(r"\bv\b", "e.`1`", re.sub(r"\bt\b", "e.`0`", _ELEMENT))


def parse_responses(files: DataFrame, ts: Column, survey: Column) -> DataFrame:
    """Rows (value, ...) of JSON text to response_id, survey_id, process_timestamp, values, response.

    ``value`` is a response, an array of responses or an object that holds one under ``responses``.
    """
    whole = F.trim(F.regexp_replace("value", "^﻿", ""))
    listed = F.from_json("value", "array<string>")
    held = F.from_json("value", "responses array<string>")["responses"]
    may_hold = F.contains("value", F.lit("responses")) | F.contains("value", F.lit("\\"))  # a key's letters may be written as escapes
    single = F.array("value")
    parts = F.when(F.startswith("value", F.lit("[")), listed).when(may_hold, F.coalesce(held, single)).otherwise(single)
    rows = (files.withColumn("value", whole).filter("value <> ''")
            .select(F.to_timestamp(ts, TS_PATTERN).alias("process_timestamp"), survey.alias("survey_id"), F.explode(parts).alias("response")))
    return _with_answers(rows)


def _with_answers(rows: DataFrame) -> DataFrame:
    read = rows.select(F.get_json_object("response", "$.responseId").alias("response_id"), "survey_id", "process_timestamp",
                       _texts("response").alias("values"), "response")
    return read.withColumn("values", _answers("response", "values"))


def answer_kinds(response: Column) -> Column:
    """The JSON kind of every answer of a response's JSON text: string, number, boolean, array, object or null.

    ``values`` holds texts only, in which the number 1 and the string "1" are the same; this map beside it tells them apart.
    """
    typed = F.from_json(response, "`values` map<string,variant>")["values"]

    def kind(v):
        schema = F.schema_of_variant(v)
        return (F.when(v.isNull() | F.is_variant_null(v), "null").when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean")
                .when(schema.startswith("ARRAY"), "array").when(schema.startswith("OBJECT"), "object").otherwise("number"))

    return F.transform_values(typed, lambda _, v: kind(v))


def _files(spark, root: str, name: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name)
    return reader.text(root, wholetext=True).select("value", plain_path(F.col("_metadata.file_path")).alias("path"))


def plain_path(encoded: Column) -> Column:
    """A file's path as it is named; ``_metadata.file_path`` is a URI, in which a plus sign stands for itself."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def read_snapshot(spark, root: str, layout: str = "partitioned", kinds: str | None = None) -> DataFrame:
    """response_id, survey_id, process_timestamp, values and response (its JSON text, all fields) (O6).

    ``layout="partitioned"`` reads our writer's folders, a response per line (partition pruning on
    both keys); ``layout="plain"`` reads a landed tree of any depth, a document of any size by as many tasks as it has
    blocks (``json_split``). A survey may have any number of pages. ``kinds`` names a further column with the
    JSON kinds of the answers (``answer_kinds``).
    """
    if kinds:
        return read_snapshot(spark, root, layout).withColumn(kinds, answer_kinds(F.col("response")))
    if layout == "plain":
        rows = landed_responses(spark, root, f"{{{JSON_NAME},{PAGE_NAME.format('*')}}}", plain_path)
        ts, survey = landed_path(F.col("path"))
        return _with_answers(rows.select(F.to_timestamp(ts, TS_PATTERN).alias("process_timestamp"), survey.alias("survey_id"), "response"))
    if layout != "partitioned":
        raise ValueError("layout must be 'partitioned' or 'plain'")
    return read_folders(spark, root, [root])


def read_folders(spark, root: str, folders: list[str]) -> DataFrame:
    """As ``read_snapshot``, of some partition folders below ``root`` only; no other folder is listed."""
    lines = spark.read.schema(PARTITIONED).option("basePath", root).text(folders)
    return parse_responses(lines, F.col("process_timestamp"), F.col("survey_id"))  # partition columns, so filters on them prune


def write_csv_header(responses: DataFrame, path: str, label=F.upper) -> None:
    """Header-only CSV per survey: question keys, then labels (O7 writer).

    Keys are the distinct answer keys of each survey (bounded by its
    questionnaire, not by its responses); ``label`` makes a key's label, upper-cased by default. Fields are
    quoted, so labels may hold commas, quotes and line breaks.
    """
    keys = (responses.select("survey_id", F.explode(F.map_keys("values")).alias("k"))
            .distinct()
            .groupBy("survey_id").agg(F.sort_array(F.collect_list("k")).alias("ks")))
    quote = lambda c: F.transform(c, lambda x: F.concat(F.lit('"'), F.regexp_replace(x, '"', '""'), F.lit('"')))
    row = lambda c: F.array_join(quote(c), ",")
    # one value per survey: a line break inside a label must not part the two rows
    rows = keys.select("survey_id", F.concat_ws("\n", row(F.col("ks")), row(F.transform("ks", label))).alias("value"))
    rows.repartition("survey_id").write.mode("overwrite").partitionBy("survey_id").text(path)


#: A field (quoted: whatever stands between its quotes, doubled ones included) and what ends it.
CSV_FIELD = r'("[^"]*+(?:""[^"]*+)*+"|[^,\n]*?)(,|\r?\n|\z)'


def csv_records(text: Column, count: int) -> list[Column]:
    """The first ``count`` records of a CSV text, each an array of its fields; null where the text has fewer.

    Fields are found one after the other from the start of the text, so commas and line breaks inside quotes belong to their field; a field
    that does not end in a comma ends its record. A quote that nothing closes, or that does not begin its field, stands for itself.
    """
    fields = F.regexp_extract_all(text, F.lit(CSV_FIELD), F.lit(1))
    ends = F.regexp_extract_all(text, F.lit(CSV_FIELD), F.lit(2))
    last = F.filter(F.sequence(F.lit(0), F.size(ends) - 1), lambda i: F.get(ends, i) != ",")

    def plain(x):
        quoted = F.rlike(x, F.lit(r'(?s)^".*"\z')) & (F.length(x) > 1)
        return F.when(quoted, F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)

    out = []
    for i in range(count):
        first = F.get(last, F.lit(i - 1)) + 2 if i else F.lit(1)  # slice counts from 1
        record = F.slice(fields, first, F.get(last, F.lit(i)) - first + 2)
        at_end = (F.get(ends, F.get(last, F.lit(i))) == "") & (record == F.array(F.lit("")))  # after the last line break
        out.append(F.when(~at_end, F.transform(record, plain)))
    return out


def read_csv_header(spark, path: str, header_rows: int = 2, layout: str = "partitioned") -> DataFrame:
    """``(survey_id, position, key, label, import_id)`` from header-only CSV files (O7).

    The first row holds the keys, the second the labels, the third the
    import ids; ``header_rows`` (1 to 3) says how many the files have, what they lack is null. Rows are records, not
    lines: a quoted label may hold line breaks.
    Header-only exports are a few records, so each file is read whole. ``layout="plain"`` takes the survey from the
    file's folder in a landed tree of any depth.
    """
    if header_rows not in (1, 2, 3):
        raise ValueError("header_rows must be 1, 2 or 3")
    if layout == "plain":
        files = _files(spark, path, CSV_NAME)
        survey = landed_path(F.col("path"))[1]
    else:
        files = spark.read.schema("value string, survey_id string").option("basePath", path).text(path, wholetext=True)
        survey = F.col("survey_id")
    rows = csv_records(F.regexp_replace("value", "^\ufeff", ""), header_rows) + [F.lit(None).cast("array<string>")] * (3 - header_rows)
    table = files.select(survey.alias("survey_id"), *(r.alias(n) for r, n in zip(rows, ("keys", "labels", "ids"), strict=True)))
    return (table.select("survey_id", "labels", "ids", F.posexplode("keys").alias("position", "key"))
            .select("survey_id", "position", "key", F.get("labels", F.col("position")).alias("label"), F.get("ids", F.col("position")).alias("import_id")))
