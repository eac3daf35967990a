"""Secret scans with corpus-wide ownership frequency, in DataFrame functions alone.

Candidates are found per text. Their hashes are then counted over the corpus: in how many
repositories and under how many owners a value stands. A value under more than ``max_owners`` owners
is a copied example; the others are specific to their owners and look live. Base candidates are
always spans; further ones (known key shapes, mixed strings) become spans only where they look live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.store import Scratch


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int
    least: int
    base: bool
    #: Further pattern that a value has to hold.
    holds: str = ""


#: The kinds in their order. Hexadecimal and access keys take their whole run, so the
#: least length can stand in the pattern; an assignment that is too short still uses up its text.
KINDS = (
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Kind(
        "known",
        r"gh[pousr]_[A-Za-z0-9]{36,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
        r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
        0,
        20,
        False,
    ),
    Kind("mixed", r"[A-Za-z0-9_-]{20,}", 0, 20, False, r"(?=[^0-9]*[0-9][^0-9]*[0-9][^0-9]*[0-9])(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z])"),
)
PART = "array<struct<kind_no:int,place:int,gap:int,whole:int,value:string>>"


def _parts(kind: Kind, number: int) -> Column:
    """Matches of one kind in column ``_text`` with the lengths of themselves and of what lies before them, one pass for all."""
    t, p = F.col("_text"), F.lit(kind.pattern)
    parts = F.arrays_zip(
        F.split(t, kind.pattern, -1).alias("gap"),
        F.regexp_extract_all(t, p, F.lit(0)).alias("whole"),
        F.regexp_extract_all(t, p, F.lit(kind.group)).alias("value"),
    )

    def part(x: Column, i: Column) -> Column:
        return F.struct(F.lit(number).alias("kind_no"), i.alias("place"), F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("whole"), x["value"].alias("value"))

    found = F.filter(F.transform(parts, part), lambda x: x["whole"].isNotNull())
    return F.when(t.rlike(kind.pattern), found).otherwise(F.array()).cast(PART)


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str | None, repo_col: str | None, kinds: tuple[Kind, ...]) -> DataFrame:
    """(id, text_hash, owner, repo, start, kind_no, end, kind, base, value_hash), a row for each candidate.

    A match starts where the lengths before it end: running sums over the matches of one text and kind, so any number of them is
    in proportion to itself.
    """
    owner = F.col(owner_col).cast("string") if owner_col else F.lit("")
    repo = F.col(repo_col).cast("string") if repo_col else F.col(id_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"), owner.alias("owner"), repo.alias("repo"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    parts = F.concat(*[_parts(k, i) for i, k in enumerate(kinds)])
    each = rows.select("_row", "id", "text_hash", "owner", "repo", F.explode(parts).alias("p")).select("_row", "id", "text_hash", "owner", "repo", "p.*")
    run = Window.partitionBy("_row", "kind_no").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("whole")).over(run).cast("int"))
    table = F.array(*[F.struct(F.lit(k.name).alias("kind"), F.lit(k.base).alias("base"), F.lit(k.least).alias("least"), F.lit(k.holds).alias("holds")) for k in kinds])
    of = F.element_at(table, F.col("kind_no") + 1)
    holds = F.lit(True)
    for i, k in enumerate(kinds):
        if k.holds:
            holds = F.when(F.col("kind_no") == i, F.rlike("value", F.lit(k.holds))).otherwise(holds)
    good = (F.length("value") >= of["least"]) & holds
    return each.where(good).select(
        "id", "text_hash", "owner", "repo", (F.col("end") - F.col("whole")).alias("start"), "kind_no", "end", of["kind"].alias("kind"), of["base"].alias("base"), F.sha2("value", 256).alias("value_hash")
    )


#: Code points of a block of a text that is redacted.
BLOCK = 4096


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str | None = "source",
    repo_col: str | None = None,
    max_owners: int = 2,
    kinds: tuple[Kind, ...] = KINDS,
) -> DataFrame:
    """Findings: (id, text_hash, secrets), one row for each distinct (id, text) that has any.

    ``secrets`` is sorted by start and kind; each has kind, start, end (code points, end exclusive), base,
    value_hash, repos, owners, live (at most ``max_owners`` owners) and after, where the spans before it end. A repository is (owner, ``repo_col``),
    the row's id if no column is given. Null owners count as one owner, a null text as empty. An extra
    candidate that meets a base span, or an extra one of an earlier kind, is left out. Repeated rows
    are one repository and get one finding. Other columns are not read. Empty tables give no findings.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    rows = scratch.save(candidates(docs, id_col, text_col, owner_col, repo_col, kinds), "candidates")
    named = [F.coalesce(c, F.lit("\x00")).alias(c) for c in ("owner", "repo")]
    each = rows.select("id", "text_hash", *named, "start", "kind_no", "end", "kind", "base", "value_hash")
    per_owner = each.select("value_hash", "owner", "repo").distinct().groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    counts = per_owner.groupBy("value_hash").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))
    known = each.select("id", "text_hash", "start", "kind_no", "end", "kind", "base", "value_hash").distinct().join(counts, "value_hash")
    known = known.withColumn("live", F.col("owners") <= max_owners).where(F.col("base") | F.col("live"))
    clear = _clear_of_earlier_kinds(known, kinds)
    before = Window.partitionBy("id", "text_hash").orderBy("start", "kind_no").rowsBetween(Window.unboundedPreceding, -1)
    clear = clear.withColumn("after", F.coalesce(F.max("end").over(before), F.lit(0)))
    item = F.struct("start", "kind_no", "end", "kind", "base", "value_hash", "repos", "owners", "live", "after")
    return clear.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(item)).alias("secrets"))


def _clear_of_earlier_kinds(known: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """Without extra candidates that meet one of an earlier kind: such a one starts before and reaches in, or starts inside."""
    text = Window.partitionBy("id", "text_hash")
    so_far = text.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    later = text.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)  # from the last one on: a frame that only grows
    met = F.lit(False)
    for i, k in enumerate(kinds):
        if not k.base:
            earlier = F.col("kind_no") < i
            reached = F.max(F.when(earlier, F.col("end"))).over(so_far) > F.col("start")
            inside = F.min(F.when(earlier, F.col("start"))).over(later) < F.col("end")
            met = F.when(F.col("kind_no") == i, F.coalesce(reached, F.lit(False)) | F.coalesce(inside, F.lit(False))).otherwise(met)
    return known.withColumn("_met", met).where(~F.col("_met")).drop("_met")


def attach(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, secrets) for every row of ``docs``; ``row`` is a struct of its columns, ``secrets`` null where there are none."""
    d = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), text_hash(text_col).alias("_hash"))
    met = d.join(findings, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("text_hash")), "left")
    return met.select("row", "secrets")


def digest(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied), one row for each row of ``docs``."""
    d = docs.select(F.col(id_col).alias("_id"), text_hash(text_col).alias("_hash"))
    met = d.join(findings, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("text_hash")), "left")
    of = F.coalesce("secrets", F.array().cast(findings.schema["secrets"].dataType))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(test) -> Column:
        return F.size(F.filter(of, test)).cast("bigint")

    def of_kind(kind: str):
        return lambda x: x["kind"] == kind

    counts = [count(of_kind(k)).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    base = F.sha2(joined(F.filter(of, lambda x: x["base"])).cast("binary"), 256).alias("base_sha256")
    live, copied = count(lambda x: x["live"]).alias("n_live"), count(lambda x: ~x["live"]).alias("n_copied")
    return met.select(F.col("_id").alias(id_col), *counts, base, joined(of).alias("spans"), live, copied)


def redact(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text", live: str = "[secret]", copied: str = "[example]") -> DataFrame:
    """``docs`` with every span replaced: by ``live`` if owner-specific, by ``copied`` if widely copied. Spans that meet are one."""
    # Most texts hold nothing and are told apart by key alone: only the others meet their findings.
    keys = findings.select(F.col("id").alias("__found_id"), F.col("text_hash").alias("__found_hash"))
    key = F.col(id_col).eqNullSafe(F.col("__found_id")) & (text_hash(text_col) == F.col("__found_hash"))
    clear, touched = docs.join(keys, key, "left_anti"), docs.join(keys, key, "left_semi")
    met = attach(touched, findings, id_col, text_col)
    text = F.col("row").getField(text_col)
    # A text is cut into blocks once; a stretch of it is put together from the blocks that it lies in.
    met = met.select("row", "secrets", F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("_blocks"), F.length(text).alias("_length"))

    def stretch(start: Column, end: Column) -> Column:
        first, last = F.floor(start / BLOCK), F.floor((end - 1) / BLOCK)

        def piece(j: Column) -> Column:
            low = F.greatest(start - j * BLOCK, F.lit(0))
            return F.substring(F.element_at("_blocks", (j + 1).cast("int")), (low + 1).cast("int"), (F.least(end - j * BLOCK, F.lit(BLOCK)) - low).cast("int"))

        return F.when(end > start, F.array_join(F.transform(F.sequence(first, F.greatest(first, last)), piece), "")).otherwise(F.lit(""))

    marked = F.filter("secrets", lambda x: x["start"] >= x["after"])
    cut = F.transform(marked, lambda x: F.concat(stretch(x["after"], x["start"]), F.when(x["live"], F.lit(live)).otherwise(F.lit(copied))))
    rest = stretch(F.array_max(F.transform("secrets", lambda x: x["end"])), F.col("_length"))
    clean = F.concat(F.array_join(cut, ""), rest)
    new = F.when(F.col("secrets").isNull(), text).otherwise(clean)
    return clear.unionByName(met.select([(new if f == text_col else F.col("row").getField(f)).alias(f) for f in docs.columns]))
