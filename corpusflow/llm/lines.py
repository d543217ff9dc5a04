"""Line dedup by distinct-site spread.

Each line (trimmed, by its 64-bit hash) gets a HyperLogLog sketch of the sites (values of `source`) that it occurs on, merged by
aggregation; lines whose estimate is near the bar get exact distinct counts. A line on MIN_SITES sites or more is spread.

A document that was copied to many sites spreads all its lines. So a second count takes sites only from witnesses: documents of
whose text spread lines make up at most half. Copies, near copies too, are no witnesses for one another, and their lines stay for
near-dedup to judge; a banner or footer of any number of lines has a witness in every page that has text of its own. Lines
that witnesses alone spread over MIN_SITES are boilerplate and are cut out of all documents; a line of over LONG bytes, a paragraph
rather than a banner, must be on LONG_SITES then, for passages are quoted too.

A page may be little but banners: a line or two of its own above a footer. It is a weak witness if it has a line that isn't spread and its spread lines
have at most BANNER bytes together, which tells it from a near copy of a longer text. Lines that witnesses of both kinds spread over SHORT_SITES
are boilerplate, too. Near copies of a text of less than BANNER bytes, each with a line of its own, can't be told from such pages and are taken for them.

Blank lines are never boilerplate. Defined results: null text stays null; a null source is a site of its own; documents
that lose all lines keep an empty text; rows whose doc_id is null, and repeated rows, are treated like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, table

MIN_SITES = 5
#: Bytes of a paragraph, and the sites that it must be on.
LONG, LONG_SITES = 150, 20
#: Bytes of the banners that a page without much text of its own may have, and the sites on which such pages count.
BANNER, SHORT_SITES = 600, 10
#: A witness has at most this share of its bytes in spread lines.
SHARE = 0.5
#: 2**LG_K registers: a relative standard error of about 0.8 / 2**(LG_K / 2).
LG_K = 11
#: Estimates within this share of the bar are counted exactly; over ten standard errors.
NEAR = 0.2
BLANK = " \t\n\x0b\x0c\r"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def occurrences(docs: DataFrame) -> DataFrame:
    """(row, line, site, size): hashes and bytes, a row for each line that is not blank. A written table: texts are split and hashed once."""
    lines = docs.where("text is not null").select(
        row_key().alias("row"),
        F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("\x01"))).alias("site"),
        F.explode(F.transform(F.split("text", "\n"), trimmed)).alias("x"),
    )
    return materialise(lines.where("x <> ''").select("row", F.xxhash64("x").alias("line"), "site", F.octet_length("x").alias("size")))


def spread(each: DataFrame, min_sites: int = MIN_SITES, long_sites: int = LONG_SITES, lg_k: int = LG_K) -> DataFrame:
    """(line, n_sites) of the lines on enough sites; counts are exact near the bar, else estimates. A written table."""
    # rarer lines can't be spread that far: most lines go before any sketch is made
    often = each.groupBy("line").agg(F.count("*").alias("n"), F.min("site").alias("s0"), F.max("site").alias("s1"))
    often = materialise(often.where((F.col("n") >= min_sites) & (F.col("s0") < F.col("s1"))).select(F.col("line").alias("l")))
    each = each.join(often, each["line"] == often["l"], "left_semi")
    bar = F.when(F.col("size") > LONG, long_sites).otherwise(min_sites)
    sketched = each.groupBy("line").agg(F.max("size").alias("size"), F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("n_sites"))
    sketched = materialise(sketched.withColumn("bar", bar).where(F.col("n_sites") >= F.col("bar") * (1 - NEAR)))
    near = F.col("n_sites") <= F.col("bar") * (1 + NEAR)
    counted = sketched.where(near).select(F.col("line").alias("l"), "bar")
    pairs = each.join(counted, each["line"] == counted["l"]).select("line", "bar", "site").distinct()
    exact = pairs.groupBy("line", "bar").agg(F.count("*").alias("n_sites")).where("n_sites >= bar").select("line", "n_sites")
    out = materialise(sketched.where(~near).select("line", "n_sites").unionByName(exact))
    discard(often)
    discard(sketched)
    return out


def spread_by_row(each: DataFrame, lines: DataFrame) -> DataFrame:
    """(row, witness, weak, spread array<struct<line, site, size>>) of the rows with spread lines. A written table."""
    of = lines.select(F.col("line").alias("l"))
    hit = F.col("l").isNotNull()
    rows = each.join(of, each["line"] == of["l"], "left").groupBy("row").agg(
        F.sum(F.when(hit, F.col("size")).otherwise(0)).alias("own"),
        F.sum("size").alias("all"),
        F.collect_set(F.when(hit, F.struct("line", "site", "size"))).alias("spread"),
    )
    weak = (F.col("own") < F.col("all")) & (F.col("own") <= BANNER)
    return materialise(rows.where("own > 0").select("row", (F.col("own") <= SHARE * F.col("all")).alias("witness"), weak.alias("weak"), "spread"))


def _free(name: str, docs: DataFrame) -> str:
    """The name, or a longer one, that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def remove_lines(docs: DataFrame, rows: DataFrame, lines: DataFrame, removed: str | None = None) -> DataFrame:
    """docs with text cut and, if it has a name, a last column of the number of lines cut; rows: spread_by_row() of docs; lines: (line)."""
    bad = lines.select(F.col("line").alias("l")).distinct()
    has = rows.select("row", F.explode("spread.line").alias("line"))
    hits = has.join(bad, has["line"] == bad["l"]).groupBy("row").agg(F.collect_set("line").alias("bad"))
    key, row, gone, kept = (_free(n, docs) for n in ("key", "row", "bad", "kept"))
    # joined the same way at every size: by sorting, so no growing table is sent to all tasks
    hits = hits.toDF(row, gone).hint("merge")
    joined = docs.withColumn(key, row_key()).join(hits, F.col(key) == F.col(row), "left")
    split = F.split("text", "\n")
    hit = F.col(gone).isNotNull()
    out = joined.withColumn(kept, F.when(hit, F.filter(split, lambda x: ~F.array_contains(F.col(gone), F.xxhash64(trimmed(x))))))
    text = F.when(hit, F.array_join(kept, "\n")).otherwise(F.col("text"))
    count = F.when(hit, F.size(split) - F.size(kept)).otherwise(0).cast("long")
    return out.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns], *([count.alias(removed)] if removed else []))


def _cut(docs: DataFrame, removed: str | None = None, min_sites: int = MIN_SITES, long_sites: int = LONG_SITES, short_sites: int = SHORT_SITES, lg_k: int = LG_K) -> DataFrame:
    each = occurrences(docs)
    rows = spread_by_row(each, spread(each, min_sites, min_sites, lg_k))
    discard(each)
    said = lambda by: rows.where(by).select(F.explode("spread").alias("x")).select("x.*")
    lines = spread(said("witness"), min_sites, long_sites, lg_k).unionByName(spread(said("witness or weak"), short_sites, max(short_sites, long_sites), lg_k))
    return remove_lines(docs, rows, lines, removed)


def deduplicate(docs: DataFrame, **bars) -> DataFrame:
    """docs without their boilerplate lines; all rows and columns stay."""
    return _cut(docs, **bars)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _cut(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "n_removed")
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_removed", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
with d as (
  select doc_id, source, string_split(text, chr(10)) raw from documents
), t as (
  select doc_id, source, raw, list_transform(raw, lambda x: regexp_replace(x, '^[\t\n\v\f\r ]+|[\t\n\v\f\r ]+$', '', 'g')) l from d
), o as (
  select doc_id, coalesce(source, chr(1)) site, line, strlen(line) size from (select doc_id, source, unnest(l) line from t) where line <> ''
), c as (
  select line from o group by line having count(distinct site) >= {MIN_SITES}
), w as (
  select doc_id, sum(case when c.line is null then 0 else size end) own, sum(size) every from o left join c using (line) group by doc_id
), b as (
  select line from o join w using (doc_id) where line in (select line from c) and own <= {SHARE} * every
  group by line having count(distinct site) >= case when max(size) > {LONG} then {LONG_SITES} else {MIN_SITES} end
  union
  select line from o join w using (doc_id) where line in (select line from c) and (own <= {SHARE} * every or own < every and own <= {BANNER})
  group by line having count(distinct site) >= case when max(size) > {LONG} then {LONG_SITES} else {SHORT_SITES} end
), k as (
  select doc_id, string_agg(raw[i], chr(10) order by i) kept, count(*) n
  from (select doc_id, raw, l, unnest(range(1, len(l) + 1)) i from t) where l[i] not in (select line from b) group by doc_id
)
select d.doc_id, coalesce(len(raw) - coalesce(n, 0), 0)::bigint n_removed, strlen(coalesce(kept, ''))::bigint n_bytes, sha256(coalesce(kept, '')) kept_sha256
from d left join k using (doc_id)
"""
