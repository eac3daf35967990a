"""Readers with explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from noticelake.sources.snapshots import staged

#: Kinds of pages up to which their stop pages are sent to every task.
MANY_KINDS = 10_000

# Alternative keys of a search item, first non-empty wins, and the defaults.
NOTICE_KEYS = {
    "portal_id": ("numeroControlePNCP", "numero_controle_pncp", "pncp_id"),
    "title": ("title", "titulo", "tituloObjeto"),
    "description": ("description", "descricao"),
    "object": ("objeto",),
    "agency": ("orgaoNome", "orgao_nome"),
    "agency_tax_id": ("orgaoCnpj", "orgao_cnpj"),
    "region": ("unidadeFederativaNome", "uf", "siglaUf"),
    "city": ("municipioNome", "municipio_nome", "cidade"),
    "modality": ("modalidadeNome", "modalidade_nome"),
    "situation": ("situacaoNome", "situacao_nome"),
    "published_text": ("dataPublicacaoPncp",),
    "event_text": ("dataAberturaProposta",),
    "value_text": ("valorTotalEstimado",),
    "source_link": ("linkSistemaOrigem",),
    "edital_link": ("linkEdital",),
}
NOTICE_DEFAULTS = {"agency": "Orgao Desconhecido", "region": "BR", "city": "Diversos", "title": "", "description": "", "object": ""}


def first_present(payload: Column, keys: Sequence[str]) -> Column:
    """First non-empty value among top-level JSON keys."""
    return F.coalesce(*[F.nullif(F.get_json_object(payload, f"$.{k}"), F.lit("")) for k in keys])


def notices_from_json(raw: DataFrame, payload: str = "value", keys=NOTICE_KEYS, defaults=NOTICE_DEFAULTS) -> DataFrame:
    """One notice row per JSON text; rows without an id are dropped."""
    cols = []
    for name, names in keys.items():
        value = first_present(F.col(payload), names)
        cols.append((F.coalesce(value, F.lit(defaults[name])) if name in defaults else value).alias(name))
    return raw.select(*cols).where(F.col("portal_id").isNotNull())


def read_notice_json(spark: SparkSession, path: str) -> DataFrame:
    return notices_from_json(spark.read.text(path))


FEED_ITEM = """
lote_id string, leilao_id string, nm_titulo_lote string, nm_descricao string, nm_cidade string, nm_estado string,
dt_fechamento string, vl_lanceminimo string, vl_venda string, vl_lanceinicial string, vl_incremento string,
nm_url_leiloeiro string, url_lote string, nm_url_lote string, link string, nm_leiloeiro string, id_categoria int,
nm_categoria string, nm_subcategoria string, statuslote_id string, nm_statuslote string, nu_visitas string,
anexos array<struct<nm: string, nm_path_completo: string>>, fotos array<struct<nm_path_completo: string>>, _tipo_busca int
"""


def feed_pages(raw: DataFrame, payload: str = "value") -> DataFrame:
    """Paged dump to one row per item; items may sit under three names, page numbers under two."""
    schema = f"""items array<struct<{_as_struct(FEED_ITEM)}>>, lotes array<struct<{_as_struct(FEED_ITEM)}>>,
        data array<struct<{_as_struct(FEED_ITEM)}>>, currentPage int, page int, totalPages int, totalItems int, _tipo_busca int"""
    page = raw.select(F.from_json(payload, schema).alias("p"))
    rows = page.select(
        F.coalesce("p._tipo_busca", F.lit(1)).alias("kind"),
        F.coalesce("p.currentPage", "p.page").alias("page"),
        F.explode(F.coalesce("p.items", "p.lotes", "p.data")).alias("i"),
    )
    return rows.select("page", F.coalesce("i._tipo_busca", "kind").alias("kind"), "i.*").drop("_tipo_busca")


def _as_struct(ddl: str) -> str:
    out, depth, part = [], 0, ""
    for ch in " ".join(ddl.split()) + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            part = ""
        else:
            part += ch
    return ", ".join(out)


def before_first_repeat(items: DataFrame, kind: str = "kind", page: str = "page", item: str = "lote_id") -> DataFrame:
    """Items of pages before the first page whose id set was seen already.

    Two pages are the same when their distinct ids agree in count, in the sum and in the exclusive-or
    of two 64-bit hashes. These are folded per task, so no page is ever gathered as a list. Pages
    without any id say nothing and are not compared.
    """
    ids = items.select(kind, page, F.col(item).cast("string").alias("_id")).distinct()
    digest = [
        F.count("_id").alias("_n"),
        F.sum(F.xxhash64("_id").cast("decimal(38,0)")).alias("_sum"),
        F.bit_xor(F.xxhash64("_id", F.lit("second"))).alias("_xor"),
    ]
    pages = ids.groupBy(kind, page).agg(*digest).where("_n > 0")
    same = W.partitionBy(kind, "_n", "_sum", "_xor")
    repeat = pages.withColumn("_first", F.min(page).over(same)).where(F.col(page) > F.col("_first"))
    # One row a kind: sent to every task while there are few, so that items never meet by kind, of which there are three.
    stop = staged(repeat.groupBy(kind).agg(F.min(page).alias("_stop")), "stops")
    few = stop.limit(MANY_KINDS + 1).count() <= MANY_KINDS
    return items.join(F.broadcast(stop) if few else stop, kind, "left").where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


#: What Latin-1 reads as control characters, and the letters that Windows-1252 has there.
WINDOWS_1252 = tuple("".join(c) for c in zip(*[(chr(i), bytes([i]).decode("cp1252")) for i in range(0x80, 0xA0) if bytes([i]).decode("cp1252", "ignore")]))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files of mixed encodings; lines are numbered from 0 in each file.

    A file is UTF-8 if all its lines are, else Windows-1252, which holds Latin-1's letters. The number of a line is the lines of
    the splits before its own and its place inside it, so it is the same for any size of splits. Lines are read and
    written down once with the offset of their split; what is put together after that is one row a split.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"),
        F.col("value").cast("binary").alias("_bytes"), F.is_valid_utf8("value").alias("_utf8"), F.monotonically_increasing_id().alias("_id"),
    )
    rows = staged(raw, "lines")
    before = W.partitionBy("file").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    splits = rows.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"), F.bool_and("_utf8").alias("_all"))
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_whole", F.bool_and("_all").over(W.partitionBy("file")))
    met = rows.join(splits.drop("_n", "_all"), ["file", "_start"])
    line = F.when(F.col("_whole"), F.decode("_bytes", "UTF-8")).otherwise(F.translate(F.decode("_bytes", "ISO-8859-1"), *WINDOWS_1252))
    return met.select("file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), F.regexp_replace(line, "^\ufeff|\r$", "").alias("line"))


def read_csv_any_encoding(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """CSV files of mixed encodings with a header, one record a line; lines that don't fit the schema are skipped.

    Columns are those of ``schema`` with file and line_no. Nothing of the files passes through the driver.
    """
    given = spark.createDataFrame([], schema).columns
    parsed = F.from_csv("line", f"{schema}, _bad string", {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = read_lines(spark, path).where((F.col("line_no") > 0) & (F.length("line") > 0)).select("file", "line_no", parsed.alias("r"))
    return rows.where("r._bad is null").select(*[F.col(f"r.{n}").alias(n) for n in given], "file", "line_no")


def read_csv_bom(spark: SparkSession, path: str) -> DataFrame:
    """CSV export with a byte-order mark: the mark is removed from the first column name."""
    df = spark.read.csv(path, header=True)
    return df.withColumnRenamed(df.columns[0], df.columns[0].lstrip("﻿"))


def cells(df: DataFrame, sheet: str, row_no: str = "line_no") -> DataFrame:
    """Every filled cell of a sheet as (row_no, column_name, cell, ref).

    ``row_no`` names the column with the stable number of a row, as the readers of files give it; records are counted from 1 after
    the header, and the reference counts lines from 1.
    """
    names = [c for c in df.columns if c not in (row_no, "file")]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("cell")) for c in names])
    out = df.select(F.col(row_no).alias("row_no"), F.explode(pairs).alias("p")).select("row_no", "p.*")
    ref = F.concat(F.lit(f"{sheet}:row="), F.col("row_no") + 1, F.lit(":col="), F.col("column_name"))
    return out.where(F.length("cell") > 0).withColumn("ref", ref)


def sheet_cells(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Cells of sheets exported as CSV, with the sheet's file in the reference."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    rows = read_csv_any_encoding(spark, path, ", ".join(f"`{f.name}` string" for f in schema.fields), sep)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("cell")) for c in columns])
    out = rows.select("file", F.col("line_no").alias("row_no"), F.explode(pairs).alias("p")).select("file", "row_no", "p.*").where(F.length("cell") > 0)
    name = F.element_at(F.split("file", "/"), -1)
    return out.withColumn("ref", F.concat(name, F.lit(":row="), F.col("row_no") + 1, F.lit(":col="), F.col("column_name")))


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(loc, lastmod, priority) of a sitemap; the schema is given so dates stay text."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string, priority double").load(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page_id long, url string, html string").parquet(path)


def read_document_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id string, file_name string, page_no int, text string").parquet(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Stored files with folder, size and extension; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -2).alias("notice_id"),
        F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]+)$", 1)).alias("extension"),
        F.col("length").alias("bytes"),
        "modificationTime",
    )


def or_fallback(dim: DataFrame, fallback: DataFrame) -> DataFrame:
    """The dimension, or the built-in list where the dimension is empty."""
    return dim if not dim.isEmpty() else fallback


def read_seeds(spark: SparkSession, path: str, status: str = "confirmed") -> DataFrame:
    """Seed file (categories -> category -> seeds) to (category, url, status), confirmed ones only."""
    schema = "categories map<string, struct<seeds: array<struct<url: string, status: string>>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("categories").alias("category", "c"))
    seeds = rows.select("category", F.explode("c.seeds").alias("s")).select("category", "s.url", "s.status")
    return seeds.where(F.col("url").isNotNull() & (F.col("status") == status))


# Where a municipality record may hold its region code.
REGION_PATHS = (
    "$.microrregiao.mesorregiao.UF.sigla",
    "$['regiao-imediata']['regiao-intermediaria'].UF.sigla",
    "$.UF.sigla",
    "$.uf",
    "$.UF",
)


def municipalities(raw: DataFrame, payload: str = "value") -> DataFrame:
    """(place_code, place_name, place_region) of municipality records with varying nesting."""
    def at(p: str) -> Column:
        value = F.get_json_object(payload, p)
        return F.when(~value.startswith("{"), F.nullif(value, F.lit("")))

    return raw.select(
        F.coalesce(at("$.id"), at("$.codigo_ibge"), at("$.codigo")).try_cast("int").alias("place_code"),
        F.coalesce(at("$.nome"), at("$.nome_municipio")).alias("place_name"),
        F.upper(F.coalesce(*[at(p) for p in REGION_PATHS])).alias("place_region"),
    ).where(F.col("place_code").isNotNull())
