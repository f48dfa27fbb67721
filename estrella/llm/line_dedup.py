"""Line dedup by site-relative frequency.

Pages are grouped by host. For every line, the pages of the host that hold it are
divided by all pages of the host; a line above the boilerplate ratio is dropped from
every page of that host. A host has fewer than (mean distinct lines per page) / ratio
such lines, whatever its size, so they travel as one short list per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.llm.common import materialize, one_of_each, packed, small, text_key

RATIO = 0.05
MIN_PAGES = 5  # of a line on fewer pages
SMALL_RATIO = 0.5  # the host's pages are asked for in this share, and two of them at least


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """128 bits of a line without its outer spaces."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def _distinct_pages(pages: DataFrame) -> DataFrame:
    """``pages(_host, _text)`` with each text once per host; only repeated texts are moved."""
    keyed = packed(pages, F.col("_host"), *text_key("_text"))
    names = ["_host", "_ta", "_tb"]
    repeated = keyed.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*names)
    return one_of_each(keyed, names, materialize(repeated, "copied")).select("row.*")


def _asked(ratio: float, min_pages: int) -> Column:
    """Share of the host's pages that a line on ``pages`` of them must exceed."""
    return F.when(F.col("pages") >= min_pages, F.lit(ratio)).otherwise(F.lit(max(ratio, SMALL_RATIO)))


def boilerplate_lines(
    docs: DataFrame, host: str, ratio: float, min_pages: int, distinct_texts: bool = False
) -> DataFrame:
    """_host, key, pages, host_pages of the lines above the ratio."""
    pages = docs.select(F.col(host).alias("_host"), F.col("text").alias("_text"))
    if distinct_texts:
        pages = _distinct_pages(pages)
    totals = pages.groupBy("_host").agg(F.count("*").alias("host_pages"))
    bare = F.array_distinct(F.transform(_lines(F.col("_text")), F.trim))
    counted = (
        pages.select("_host", F.explode(bare).alias("line"))
        .where("line <> ''")
        .select("_host", _key(F.col("line")).alias("key"))
        .groupBy("_host", "key")
        .agg(F.count("*").alias("pages"))
        .where("pages > 1")
    )
    totals = totals.withColumnRenamed("_host", "_site")
    return counted.join(
        small(materialize(totals, "hosts")), F.col("_host").eqNullSafe(F.col("_site"))
    ).where(F.col("pages") > _asked(ratio, min_pages) * F.col("host_pages")).drop("_site")


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct_texts: bool = False,
) -> DataFrame:
    """``docs`` with the lines of ``text`` that are boilerplate on their host left out.

    A line (compared without outer spaces) is boilerplate if the pages of its host that hold
    it are more than ``ratio`` of the host's pages; a line on fewer than ``min_pages`` pages
    must be on more than half of them (SMALL_RATIO), and on two at least, so that small
    hosts lose their menus and keep their lines. Blank lines stay. Adds n_lines and n_dropped (a text of null stays null and has 0 of each); input
    columns of those names are replaced. A null host is a host of its own; repeated rows
    count as pages; all other columns and all rows are kept; no rows give no rows.

    With ``distinct_texts`` rows of a host with the same text count as one page (null texts
    as one), so that copies of a document do not make its own lines boilerplate.
    """
    found = materialize(boilerplate_lines(docs, host, ratio, min_pages, distinct_texts), "boilerplate")
    drops = small(
        materialize(
            found.groupBy(F.col("_host").alias("_llm_host")).agg(F.collect_list("key").alias("_llm_drop")), "drops"
        )
    )
    kept = F.filter(
        _lines(F.col("text")),
        lambda line: ~F.coalesce(F.array_contains(F.col("_llm_drop"), _key(line)), F.lit(False)),
    )
    joined = docs.join(drops, F.col(host).eqNullSafe(F.col("_llm_host")), "left")
    count = F.coalesce(F.size(_lines(F.col("text"))), F.lit(0))
    new = F.when(F.col("_llm_drop").isNull(), F.col("text")).otherwise(F.array_join("_llm_kept", "\n"))
    dropped = F.when(F.col("_llm_drop").isNull() | F.col("text").isNull(), F.lit(0)).otherwise(
        F.col("n_lines") - F.size("_llm_kept")
    )
    rest = [f"`{c}`" for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    out = joined.withColumns(
        {"_llm_kept": kept, "n_lines": F.when(F.col("text").isNull(), F.lit(0)).otherwise(count).cast("bigint")}
    ).withColumns({"_llm_text": new, "n_dropped": dropped.cast("bigint")})
    return out.select(
        *[F.col(c) for c in rest], F.col("_llm_text").alias("text"), "n_lines", "n_dropped"
    )


# The same rule in DuckDB SQL.
SQL = f"""
with l as (
  select doc_id, source, unnest(string_split(text, chr(10))) line,
    unnest(range(len(string_split(text, chr(10))))) pos
  from documents where text is not null),
hosts as (select source, count(*) host_pages from documents group by 1),
bad as (
  select c.source, c.line from (
    select source, trim(line) line, count(distinct doc_id) pages from l where trim(line) <> '' group by 1, 2) c
  join hosts h on h.source is not distinct from c.source
  where pages > 1 and pages > case when pages >= {MIN_PAGES} then {RATIO} else {SMALL_RATIO} end * host_pages),
marked as (
  select l.*, b.line is not null drop from l
  left join bad b on b.source is not distinct from l.source and b.line = trim(l.line)),
out as (
  select doc_id, count(*) n_lines, count(*) filter (drop) n_dropped,
    coalesce(string_agg(line, chr(10) order by pos) filter (not drop), '') cleaned
  from marked group by 1)
select d.doc_id, case when d.text is null then null else cleaned end "text",
  coalesce(n_lines, 0)::bigint n_lines, coalesce(n_dropped, 0)::bigint n_dropped
from documents d left join out using (doc_id)
"""
