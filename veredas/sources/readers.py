"""Readers for the raw formats: delimited text, fixed width, paged JSON, archives, partitioned copies."""

from __future__ import annotations

import csv
import io
import shutil
import time
import urllib.request
import zipfile
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class CsvSource:
    """Where a raw table comes from and how it is written."""

    table: str
    origin: str
    path: str
    encoding: str = "UTF-8"
    delimiter: str = ","
    source_url: str = ""
    as_of_date: str = ""


#: Raw tables by origin; delimited files with their separator and encoding.
RAW_TABLES = {
    "valor": "ranking_2025 bancos_2025 seguradoras_2025 controle_empresas_walk".split(),
    "cvm": "cad_cia_aberta fre_posicao_acionaria_2026 fre_capital_social_2026 fca_valor_mobiliario_2026".split(),
    "bcb": "entidades_supervisionadas ifdata_cadastro ifdata_ativo_total_prudencial".split(),
    "susep": "dados_cadastrais receitas_seguros_2026".split(),
    "b3": "listed_companies listed_supplement cotahist_2026".split(),
    "rf": "empresas estabelecimentos socios".split(),
}


def source_registry(root: str, as_of: str | Mapping[str, str] = "", urls: Mapping[str, str] | None = None) -> dict[str, CsvSource]:
    """One source per delimited raw table under ``root``; the registry's own tables come as partitioned files.

    ``as_of`` is one date for all or a date per table, ``urls`` has where each table was taken from.
    """
    dated = as_of if isinstance(as_of, Mapping) else dict.fromkeys((t for ts in RAW_TABLES.values() for t in ts), as_of)
    out = {}
    for origin, tables in RAW_TABLES.items():
        if origin == "rf":
            continue
        for t in tables:
            old = origin in ("cvm", "susep")
            out[t] = CsvSource(t, origin, f"{root}/{origin}/{t}.csv", "ISO-8859-1" if old else "UTF-8", ";" if old else ",", (urls or {}).get(t, ""), dated.get(t, ""))
    return out


def required_files(files: Mapping[str, str], folder: str) -> dict[str, str]:
    """Copies the named files into ``folder`` and returns their new paths; if any is missing nothing is copied and all that miss are named."""
    missing = sorted(f"{name} ({path})" for name, path in files.items() if not Path(path).is_file())
    if missing:
        raise FileNotFoundError("missing: " + ", ".join(missing))
    Path(folder).mkdir(parents=True, exist_ok=True)
    return {name: str(shutil.copyfile(path, Path(folder) / Path(path).name)) for name, path in files.items()}


def header_of(content: bytes, encoding: str, delimiter: str) -> list[str]:
    """Column names of a delimited file; a byte-order mark goes, a blank name becomes ``_col_N``."""
    text = content.decode("utf-8-sig" if encoding.upper().replace("-", "") == "UTF8" else encoding, errors="replace").lstrip("﻿")
    return column_names(next(csv.reader(io.StringIO(text), delimiter=delimiter), []))


def column_names(header: list[str]) -> list[str]:
    """The fields of a header line as column names; a byte-order mark goes, a blank name becomes ``_col_N``."""
    return [n.lstrip("\ufeff").strip() or f"_col_{i}" for i, n in enumerate(header)]


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of each file, hashed on the executors."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def read_strings(spark: SparkSession, source: CsvSource, names: list[str] | None = None) -> DataFrame:
    """A delimited file with every column as text. Quoted line breaks and short rows are allowed."""

    def reader():
        out = spark.read.option("sep", source.delimiter).option("encoding", source.encoding).option("quote", '"').option("escape", '"')
        return out.option("multiLine", True).option("mode", "PERMISSIVE")

    if names is None:
        # the same reader decodes the header and the rows
        first = reader().option("header", False).csv(source.path).limit(1).collect()
        names = column_names(["" if n is None else n for n in first[0]] if first else [])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return reader().schema(schema).option("header", True).option("enforceSchema", True).csv(source.path)


#: Columns of the quotation line, 1-based start and length.
QUOTATION = {"DATA_PREGAO": (3, 8), "CODBDI": (11, 2), "CODNEG": (13, 12), "TPMERC": (25, 3), "PREULT": (109, 13), "NUMNEG": (148, 5)}


def fixed_width(lines: DataFrame, fields: dict[str, tuple[int, int]], keep: Column, least: int) -> DataFrame:
    """Fields cut out of ``value``; lines shorter than ``least`` or not in ``keep`` go."""
    return lines.where((F.length("value") >= least) & keep).select(*[F.trim(F.substring("value", at, n)).alias(name) for name, (at, n) in fields.items()])


def latin_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of ISO-8859-1 files, one character per byte, so that columns stay where they are.

    The text source takes lines as UTF-8 and leaves their bytes alone; they are decoded in the plan, and files stay splittable.
    """
    return spark.read.text(path).select(F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value"))


def read_quotations(spark: SparkSession, path: str) -> DataFrame:
    """Cash-market quotation lines of round lots."""
    at = lambda start, n: F.substring("value", start, n)
    wanted = (at(1, 2) == "01") & (at(11, 2) == "02") & (at(25, 3) == "010")
    return fixed_width(latin_lines(spark, path), QUOTATION, wanted, 152)


def zip_members(spark: SparkSession, path: str, member: str) -> DataFrame:
    """(path, value): the lines of one member of each archive; an archive without it fails."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    found = [n for n in z.namelist() if n == member or (member.startswith("*") and n.upper().endswith(member[1:].upper()))]
                    if len(found) != 1:
                        raise ValueError(f"{name}: {len(found)} members match {member}")
                    with z.open(found[0]) as f:
                        chunk: list[str] = []
                        for line in io.TextIOWrapper(f, encoding="latin-1"):
                            chunk.append(line.rstrip("\r\n"))
                            if len(chunk) == 50_000:
                                yield pd.DataFrame({"path": name, "value": chunk})
                                chunk = []
                        yield pd.DataFrame({"path": name, "value": pd.Series(chunk, dtype="object")})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(lines, "path string, value string")


def read_odata(spark: SparkSession, path: str, schema: T.StructType, condition: Column | None = None) -> DataFrame:
    """Rows of saved service pages (an array ``value`` per file), kept where ``condition`` holds.

    A page without the array fails rather than passing for an empty one.
    """
    page = T.StructType([T.StructField("value", T.ArrayType(schema))])
    pages = spark.read.schema(page).option("multiLine", True).json(path)
    checked = pages.withColumn("value", F.when(F.col("value").isNotNull(), F.col("value")).otherwise(F.raise_error(F.lit("a page has no array named value"))))
    rows = checked.select(F.explode("value").alias("v")).select("v.*")
    return rows.where(condition) if condition is not None else rows


def odata_pages(first: str, fetch: Callable[[str], dict]) -> Iterator[list[dict]]:
    """The ``value`` arrays of a service, following its link to the next page."""
    url: str | None = first
    while url:
        page = fetch(url)
        if not isinstance(page.get("value"), list):
            raise ValueError(f"{url}: no array named value")
        yield page["value"]
        url = page.get("@odata.nextLink") or page.get("odata.nextLink")


def fetched(url: str, attempts: int = 4, timeout: int = 180, wait: Callable[[float], None] = time.sleep, get: Callable[[str, int], bytes] | None = None) -> bytes:
    """The content at ``url``, tried again after 1, 2, 4 ... seconds."""
    read = get or (lambda u, t: urllib.request.urlopen(u, timeout=t).read())  # noqa: S310
    for n in range(attempts):
        try:
            return read(url, timeout)
        except OSError:
            if n + 1 == attempts:
                raise
            wait(2.0**n)
    raise ValueError("attempts must be positive")


def in_parallel(spark: SparkSession, codes: DataFrame, code: str, fetch: Callable[[str], dict | None], schema: T.StructType, workers: int = 6) -> DataFrame:
    """One row per code that ``fetch`` answers, asked by ``workers`` tasks side by side."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for c in batch[code] if (r := fetch(c)) is not None]
            yield pd.DataFrame(rows, columns=schema.names)

    return codes.select(code).where(F.col(code).isNotNull()).distinct().repartition(workers, code).mapInPandas(ask, schema)


def page_token(**payload: str) -> Column:
    """The JSON payload of a page request in base64."""
    return F.base64(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in payload.items()])).cast("binary"))


def last_arrival(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """Of repeated keys the row that came last."""
    w = F.max_by(F.struct(*df.columns), F.col(arrival))
    return df.groupBy(key).agg(w.alias("_r")).select("_r.*")


def numbered_pages(fetch: Callable[[int], dict]) -> Iterator[list[dict]]:
    """The ``results`` arrays of pages 1 to the total that each page states."""
    number, total = 1, 1
    while number <= total:
        page = fetch(number)
        if not isinstance(page.get("results"), list):
            raise ValueError(f"page {number}: no array named results")
        yield page["results"]
        total = int((page.get("page") or {}).get("totalPages") or 1)
        number += 1


def listed_companies(rows: DataFrame, arrival: str) -> DataFrame:
    """Listed companies of type 1 with padded numbers, of each number the row that came last, by number."""
    digits = F.regexp_replace(F.coalesce(F.col("cnpj").cast("string"), F.lit("")), "[^0-9]", "")
    kept = rows.where((F.col("type").cast("string") == "1") & (digits != "")).withColumn("cnpj", F.lpad(digits, F.greatest(F.length(digits), F.lit(14)), F.lit("0")))
    return last_arrival(kept, "cnpj", arrival).orderBy("cnpj")


def partition_of(spark: SparkSession, path: str, column: str, day: str) -> DataFrame:
    """One partition of a partitioned table; the scan reads no other."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(day).cast("date"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The code dictionary: table, column, key and label as text."""
    return spark.read.option("header", True).csv(path)
