"""Contract validation and routing of records to the main table or to quarantine."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.arrays import tags_to_text
from noticelake.functions.dates import contract_date
from noticelake.functions.text import is_missing
from noticelake.functions.urls import add_scheme, is_contract_url
from noticelake.operators.keyed import upsert_replace
from noticelake.operators.once import compute_once
from noticelake.presets import br_notices as br

INFO_CODES = ("url_normalized", "tags_normalized")


@dataclass(frozen=True)
class Contract:
    required: Sequence[str] = br.REQUIRED
    sellable: Sequence[str] = br.SELLABLE
    date_fields: Sequence[str] = br.DATE_FIELDS
    url_fields: Sequence[str] = br.URL_FIELDS
    critical_url_fields: Sequence[str] = br.CRITICAL_URL_FIELDS
    text_as_url: Sequence[str] = br.TEXT_AS_URL
    tag_field: str = "tags"
    forbidden_tag: str = br.FORBIDDEN_TAG


def _error(cond: Column, code: str, field: str, message: Column | str) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(field).alias("field"), text.alias("message")))


def validate(df: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Adds ``status``, ``errors`` and a normalized copy of tags, dates and URLs.

    Fields the contract names but the input lacks count as missing. Every field is parsed once;
    errors and status are plain conditions over the parsed values.
    """
    c = contract
    for name in {*c.required, *c.sellable}:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    plain = df.columns
    dates = [n for n in c.date_fields if n in plain]
    urls = [n for n in c.url_fields if n in plain]

    parsed: dict[str, Column] = {}
    if c.tag_field in plain:
        parts = F.transform(F.split(F.col(c.tag_field), ","), lambda x: F.trim(x))
        parsed["_tags"] = F.filter(parts, lambda t: (F.length(t) > 0) & (F.upper(t) != c.forbidden_tag.upper()))
        parsed["_tag_count"] = F.size(parts)
    parsed |= {f"_date_{n}": contract_date(F.col(n)) for n in dates}
    for n in urls:
        raw = F.trim(F.col(n))
        parsed[f"_url_{n}"] = add_scheme(raw)
        parsed[f"_url_ok_{n}"] = is_contract_url(add_scheme(raw))
    df = compute_once(df, parsed)

    errors: list[Column] = []
    fatal: list[Column] = []
    value: dict[str, Column] = {}
    if c.tag_field in plain:
        tags = F.col(c.tag_field)
        changed = ~is_missing(tags) & (F.size("_tags") != F.col("_tag_count"))
        value[c.tag_field] = F.when(changed, tags_to_text(F.col("_tags"))).otherwise(tags)
        errors.append(_error(changed, "tags_normalized", c.tag_field, f'Token "{c.forbidden_tag}" removido das tags'))
        empty = changed & (F.size("_tags") == 0)
        errors.append(_error(empty, "tags_empty_after_normalization", c.tag_field, "tags ficou vazia após normalização"))
    for n in dates:
        raw, good = F.col(n), F.col(f"_date_{n}")
        slash = ~is_missing(raw) & F.contains(raw, F.lit("/"))
        bad = ~is_missing(raw) & ~F.contains(raw, F.lit("/")) & good.isNull()
        value[n] = F.coalesce(good, raw)
        errors.append(_error(slash, "invalid_date_format", n, f"{n} usa separador proibido (use DD-MM-YYYY)"))
        errors.append(_error(bad, "invalid_date_format", n, f"{n} inválida (esperado DD-MM-YYYY)"))
        fatal += [slash, bad]
    for n in urls:
        raw, url = F.trim(F.col(n)), F.col(f"_url_{n}")
        present = ~is_missing(raw)
        words = present & F.upper(raw).isin(list(c.text_as_url))
        invalid = present & ~words & ~F.col(f"_url_ok_{n}")
        value[n] = F.when(present & ~words, url).otherwise(F.col(n))
        errors.append(_error(words, "text_as_url", n, F.concat(F.lit(f"{n} parece texto, não URL: "), raw)))
        errors.append(_error(present & ~words & (url != raw), "url_normalized", n, f"{n} normalizada (www. -> https://www.)"))
        errors.append(_error(invalid, "invalid_url", n, F.concat(F.lit(f"{n} inválida pelo contrato: "), url)))
        if n in c.critical_url_fields:
            fatal += [words, invalid]

    def missing(n: str) -> Column:
        return is_missing(value.get(n, F.col(n)))

    for n in c.required:
        errors.append(_error(missing(n), "missing_required_field", n, f"Campo obrigatório ausente: {n}"))
    status = (
        F.when(_any(fatal), F.lit("rejected"))
        .when(_any([missing(n) for n in c.sellable]), F.lit("not_sellable"))
        .when(_any([missing(n) for n in c.required]), F.lit("draft"))
        .otherwise(F.lit("valid"))
    )
    return df.select(
        *plain, status.alias("status"), F.array_compact(F.array(*errors)).alias("errors"), F.struct(*[v.alias(n) for n, v in value.items()]).alias("normalized")
    )


def _any(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.or_, [F.coalesce(x, F.lit(False)) for x in conditions], F.lit(False))


def reason(errors: Column, status: Column, info_codes: Sequence[str] = INFO_CODES) -> Column:
    """Struct(code, detail): first error, else first informational code, else the status."""
    serious = F.filter(errors, lambda e: ~e["code"].isin(list(info_codes)))
    first = F.coalesce(F.get(serious, F.lit(0)), F.get(errors, F.lit(0)))
    return F.struct(
        F.coalesce(first["code"], status).alias("code"),
        F.coalesce(first["message"], F.concat(F.lit("Status: "), status)).alias("detail"),
    )


def route(validated: DataFrame, key: str, run_id: str, raw_columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows for the main table with normalized values, quarantine rows)."""
    norm = validated.schema["normalized"].dataType.fieldNames()
    plain = [c for c in validated.columns if c not in ("status", "errors", "normalized", *norm)]
    main = validated.where(F.col("status") == "valid").select(*plain, *[F.col(f"normalized.{n}").alias(n) for n in norm])
    why = reason(F.col("errors"), F.col("status"))
    run = F.col(run_id) if run_id in validated.columns else F.lit(run_id)
    quarantine = validated.where(F.col("status") != "valid").select(
        run.alias("run_id"),
        F.col(key).cast("string").alias("record_id"),
        "status",
        why["code"].alias("reason_code"),
        why["detail"].alias("reason_detail"),
        "errors",
        F.to_json(F.struct(*raw_columns)).alias("raw_record"),
        F.to_json("normalized").alias("normalized_record"),
    )
    return main, quarantine


def merge_quarantine(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per run and record; the same record of the same run is updated, never repeated."""
    return upsert_replace(stored, batch, ["run_id", "record_id"], keep=[c for c in ("created_at",) if c in stored.columns])


def keys_routed_to_both(validated: DataFrame, key: str) -> DataFrame:
    """Count of keys that ``route`` sends to both tables; must be 0. The rows are validated once, not once for each table."""
    valid = F.col("status") == "valid"
    keys = validated.select(F.col(key).cast("string").alias("k"), valid.alias("valid")).where("k is not null")
    each = keys.groupBy("k").agg(F.max("valid").alias("main"), F.min("valid").alias("only_main"))
    return each.agg(F.count_if(F.col("main") & ~F.col("only_main")).alias("keys_in_both"))


def keys_in_both(main: DataFrame, quarantine: DataFrame, main_key: str, quarantine_key: str = "record_id") -> DataFrame:
    """Count of keys present in both tables; must be 0."""
    q = quarantine.select(F.col(quarantine_key).cast("string").alias("k")).distinct()
    m = main.select(F.col(main_key).cast("string").alias("k")).distinct()
    return m.join(q, "k", "left_semi").agg(F.count(F.lit(1)).alias("keys_in_both"))
