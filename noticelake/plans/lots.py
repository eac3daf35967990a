"""Lots out of document text or table rows, and lot views per notice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelake.functions import extract as X
from noticelake.functions.classify import column_role, table_is_relevant
from noticelake.functions.ids import lot_id
from noticelake.functions.money import parse_money
from noticelake.functions.text import collapse_space, lot_number
from noticelake.operators.once import compute_once
from noticelake.presets import br_notices as br


def document_family(pages: DataFrame, table_rows: DataFrame) -> DataFrame:
    """(doc_id, family, chars, pages, tables, first_table_page, processable).

    Pages: doc_id, page_no, text. Table rows: doc_id, page_no, table_no, row_no, cells.
    """
    text = pages.groupBy("doc_id").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"), F.max("page_no").alias("pages"))
    tables = (
        table_rows.groupBy("doc_id", "page_no", "table_no")
        .agg(F.min_by("cells", "row_no").alias("header"), F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") >= 2) & table_is_relevant(F.col("header"), br.TABLE_WORDS, br.TABLE_SKIP_WORDS))
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("tables"), F.min("page_no").alias("first_table_page"))
    )
    j = text.join(tables, "doc_id", "left").withColumn("tables", F.coalesce("tables", F.lit(0)))
    family = (
        F.when(F.col("chars") < br.SCANNED_BELOW_CHARS, F.lit("PDF_ESCANEADO"))
        .when(F.col("first_table_page").isNull(), F.lit("PDF_NATIVO_SEM_TABELA"))
        .when(F.col("first_table_page") <= br.EARLY_TABLE_PAGE, F.lit("PDF_TABELA_INICIO"))
        .otherwise(F.lit("PDF_TABELA_MEIO_FIM"))
    )
    return j.select("doc_id", family.alias("family"), "chars", "pages", "tables", "first_table_page", (F.col("chars") >= br.SCANNED_BELOW_CHARS).alias("processable"))


def join_pages(pages: DataFrame) -> DataFrame:
    """Pages of a document as one text in page order; bounded by the size of one document."""
    parts = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p"))
    return parts.select("doc_id", F.array_join(F.transform("p", lambda x: F.coalesce(x["text"], F.lit(""))), "\n").alias("text"))


def lots_from_text(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lots found by block patterns: doc_id, line_no, lot_no_raw, description_raw, value_raw, source_text."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.posexplode(X.lot_blocks(F.col(text))).alias("line_no", "b"))
    body = F.regexp_replace(F.col("b.body"), r"(?s)CHECK LIST.*$", "")
    lines = F.filter(F.transform(F.split(body, r"\n"), lambda x: F.trim(x)), lambda s: F.length(s) > 0)
    first = F.get(lines, F.lit(0))
    headline = F.when((F.upper(first) == "RENAVAM") & (F.size(lines) > 1), F.get(lines, F.lit(1))).otherwise(first)
    blocked = F.col("b.value").isNotNull()
    return rows.select(
        "doc_id",
        "line_no",
        F.when(blocked, F.lpad(F.col("b.lot_no"), F.greatest(F.length("b.lot_no"), F.lit(2)), F.lit("0"))).otherwise(F.col("b.lot_no")).alias("lot_no_raw"),
        F.when(blocked, headline).otherwise(F.col("b.body")).alias("description_raw"),
        F.col("b.value").alias("value_raw"),
        F.col("b.body").alias("source_text"),
        F.lit(None).cast("map<string,string>").alias("given"),
    )


def lots_from_tables(table_rows: DataFrame) -> DataFrame:
    """Lots of table rows. The header row of each table assigns roles to cells by position."""
    table = W.partitionBy("doc_id", "page_no", "table_no").orderBy("row_no")
    seen = table.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Roles are made out of the first row alone and handed down with it: one shuffle, one sort, and no row is looked at twice.
    numbered = table_rows.withColumn("_place", F.row_number().over(table)).withColumn("head_row", F.first("row_no").over(seen))
    own = F.when(F.col("_place") == 1, F.transform("cells", lambda c: column_role(c, br.COLUMN_ROLES)))
    j = numbered.withColumn("_own", own).withColumn("roles", F.last("_own", ignorenulls=True).over(seen)).where(F.col("_place") > 1)
    j = j.where(F.array_contains("roles", "descricao") | F.array_contains("roles", "numero")).drop("_own", "_place")
    pairs = F.filter(
        F.arrays_zip(F.col("roles").alias("role"), F.col("cells").alias("cell")),
        lambda x: x["role"].isNotNull() & (F.length(F.trim(x["cell"])) > 0),
    )
    # A later column of the same role wins, as in a left-to-right read.
    j = compute_once(j, {"_pairs": pairs})
    last = {role: F.trim(F.try_element_at(F.filter("_pairs", _has_role(role)), F.lit(-1))["cell"]) for role, _ in br.COLUMN_ROLES}
    given = F.map_from_arrays(F.array(*[F.lit(role) for role in last]), F.array(*last.values()))
    j = j.withColumn("given", given)
    g = F.col("given")
    joined = F.nullif(F.concat_ws(" - ", g["marca"], g["modelo"], g["placa"]), F.lit(""))
    return j.select(
        "doc_id",
        F.col("row_no").alias("line_no"),
        F.coalesce(g["numero"], (F.col("row_no") - F.col("head_row")).cast("string")).alias("lot_no_raw"),
        F.coalesce(g["descricao"], joined).alias("description_raw"),
        g["valor"].alias("value_raw"),
        F.array_join("cells", " | ", "").alias("source_text"),
        "given",
    ).where(F.col("description_raw").isNotNull())


def _has_role(role: str):
    return lambda x: x["role"] == role


def parse_lots(raw: DataFrame, min_description: int = 5) -> DataFrame:
    """Parsed fields, stable id, and ``error_code`` (NULL for a usable lot)."""
    given = F.col("given")
    text = F.upper(F.concat_ws(" ", "description_raw", "source_text"))
    base = compute_once(raw, {"_text": text, "lot_no": lot_number(F.col("lot_no_raw")), "description": collapse_space(F.col("description_raw"))})
    t = F.col("_text")
    year = F.nullif(F.regexp_extract(F.coalesce(given["ano"], F.lit("")), r"((?:19|20)\d{2})", 1), F.lit("")).try_cast("int")
    fields = compute_once(
        base,
        {
            "value": parse_money(F.col("value_raw")), "plate": F.coalesce(given["placa"], X.plate(t, br.NOT_A_PLATE)),
            "chassis": F.coalesce(given["chassi"], X.chassis(t)), "renavam": F.coalesce(given["renavam"], X.renavam(t)),
            "_listed": X.brand(t, br.BRANDS), "model_year": F.coalesce(year, X.model_year(t)),
            "lot_id": lot_id(F.col("doc_id"), F.col("lot_no"), F.col("description_raw")),
        },
    )
    # The model follows the listed brand of the text, whatever the cell says; with neither, the word after the kind of vehicle is the brand.
    unnamed = given["marca"].isNull() & F.col("_listed").isNull()
    out = fields.select(
        "doc_id", "line_no", "lot_no", "description", "value_raw", "value", "plate", "chassis", "renavam",
        F.coalesce(given["marca"], "_listed", X.named_brand(t)).alias("brand"),
        F.coalesce(given["modelo"], X.model(t, F.col("_listed")), F.when(unnamed, X.named_model(t))).alias("model"), "model_year", "lot_id",
    )
    error = (
        F.when(F.coalesce(F.length("lot_no"), F.lit(0)) == 0, F.lit("NUMERO_LOTE_AUSENTE"))
        .when(F.coalesce(F.length("description"), F.lit(0)) < min_description, F.lit("DESCRICAO_INSUFICIENTE"))
        .when(F.col("value_raw").isNotNull() & F.col("value").isNull(), F.lit("VALOR_NAO_PARSEAVEL"))
    )
    return out.withColumn("error_code", error)


def split_lots(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable lots, quarantine). A value that cannot be read is kept as NULL on a usable lot."""
    bad = F.coalesce(F.col("error_code").isin("NUMERO_LOTE_AUSENTE", "DESCRICAO_INSUFICIENTE"), F.lit(False))
    return parsed.where(~bad), parsed.where(bad)


def accept_external(rows: DataFrame, min_description: int = 5) -> DataFrame:
    """Lot rows produced elsewhere; only those with a number and a description are taken."""
    return rows.where((F.length(F.trim("lot_no_raw")) > 0) & (F.length(F.trim("description_raw")) >= min_description))


def skip_processed(files: DataFrame, processed: DataFrame, force: bool = False) -> DataFrame:
    """Files whose content hash was not processed; ``force`` takes all."""
    return files if force else files.join(processed.select("content_hash").distinct(), "content_hash", "left_anti")


def notices_without_lots(notices: DataFrame, lots: DataFrame, as_of, event: str = "event_at", has_file: Column | None = None, key: str = "notice_id") -> DataFrame:
    future = notices.where(F.col(event) >= F.lit(as_of).cast("timestamp"))
    if has_file is not None:
        future = future.where(has_file)
    return future.join(lots.select(key).distinct(), key, "left_anti")


def lot_summary(notices: DataFrame, lots: DataFrame, key: str, value: str, brand: str, keep: list[str]) -> DataFrame:
    """Per notice: lots, lots with value, value, distinct brands, sorted brand list.

    Two levels (notice and brand, then notice): a notice with very many lots is folded in every task
    first, and the list holds distinct brands only.
    """
    v = F.col(value).cast("decimal(18,2)")
    inner = lots.groupBy(key, brand).agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("nv"), F.sum(v).alias("sv"))
    per = inner.groupBy(key).agg(
        F.sum("n").alias("lots"),
        F.sum("nv").alias("lots_with_value"),
        F.sum("sv").alias("value_total"),
        F.count(brand).alias("brands"),
        F.sort_array(F.collect_list(brand)).alias("brand_list"),
    )
    j = notices.select(*keep).join(per, key, "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("lots", "lots_with_value", "brands")}
    return j.withColumns(zero)


def lots_of_notice(notices: DataFrame, lots: DataFrame, natural_key: str, value, key: str = "notice_id", order: str = "lot_no") -> DataFrame:
    """Lots of one notice found by its natural key, ordered by lot number as text."""
    one = notices.where(F.col(natural_key) == F.lit(value)).select(key)
    return lots.join(one, key).orderBy(order)


def lot_label(lot_no: Column, brand: Column, model: Column, year: Column, description: Column) -> Column:
    """``number: brand model year`` or ``number: description``; parts that are missing are left out."""
    vehicle = F.nullif(F.concat_ws(" ", brand, model, F.when(F.coalesce(brand, model).isNotNull(), year.cast("string"))), F.lit(""))
    return F.concat_ws(": ", F.nullif(lot_no, F.lit("")), F.coalesce(vehicle, F.substring(description, 1, 30)))


def lot_preview(lots: DataFrame, key: str, order: str, label: Column, max_len: int = 100, empty: str = "Sem lotes cadastrados", tie: Sequence[str] = ()) -> DataFrame:
    """Joined labels per notice, cut at ``max_len``. ``tie`` columns decide between lots of one place.

    Only the leading lots can appear in the preview: a label takes at least one character and a
    separator three, so the first ``max_len`` lots decide the result and the rest is not gathered.
    """
    w = W.partitionBy(key).orderBy(order, *tie)
    head = lots.select(key, order, *tie, label.alias("label")).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_len)
    listed = head.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_rn", "label"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["label"]), " | ")
    return listed.select(
        key, F.when(F.length(joined) > max_len, F.concat(F.substring(joined, 1, max_len - 3), F.lit("..."))).otherwise(F.coalesce(joined, F.lit(empty))).alias("preview")
    )
