"""Secrets, told apart by corpus-wide ownership frequency. DataFrame functions only.

Base spans (assign, access, hex) are exact leftmost non-overlapping matches per kind. Further candidates, `opaque`, are
runs of OPAQUE or more key characters with digits and letters of both cases that overlap no base span. Every candidate's
value is hashed; hashes are counted by distinct repositories (the source) and distinct owners (the source up to its first
slash). A value that more than OWNERS owners hold is a widely copied example; one held by fewer is specific to its owners
and looks live. Opaque candidates become spans only when they look live; base spans always stay.

Counting goes in two steps, by (hash, repository) and then by hash, each combined before its shuffle, so a value that a
third of all rows hold costs no more than any other. Rows carry an id of their own within the staged table, so equal
documents stay apart. The text is read once; everything after works on the few rows that hold candidates.

Defined cases: a null text is empty and has no spans; a null source is one repository of its own, of one owner; repeated
rows give equal rows; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import staged, table

KINDS = ["assign", "access", "hex", "opaque"]
#: Key characters of an opaque candidate at least; owners of a value that looks live at most.
OPAQUE, OWNERS = 20, 2
#: Matches whose positions are found by one fold.
RUN = 128

# fixed values: the base patterns
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY = rf"[A-Za-z0-9_-]{{{OPAQUE},}}"


def _let(value: Column, body) -> Column:
    """body(value), with the value made once however often body names it."""
    return F.transform(F.array(value), body)[0]


def _found(text: Column, pattern: str, kind: int, group: int | None = None) -> Column:
    """Array of (start, kind, end, value) of all matches, by position; value is a group of the pattern, or the match.

    The stretches between matches and the matches themselves alternate, so their running lengths are the positions. A
    fold copies the array that it extends, so runs of RUN matches are folded by themselves and then moved by the lengths of
    the runs before: work is linear in the text for any number of matches that a text can hold.
    """
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + x["gap"]
        last = first + F.length(x["whole"])
        span = F.struct(first.alias("start"), F.lit(kind).alias("kind"), last.alias("end"), x["value"].alias("value"))
        return F.struct(last.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def moved(run: Column, by: Column) -> Column:
        at = lambda s, k: (s[k] + by).alias(k)
        return F.transform(run["spans"], lambda s: F.struct(at(s, "start"), s["kind"].alias("kind"), at(s, "end"), s["value"].alias("value")))

    def placed(steps: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int")), lambda r: F.aggregate(F.slice(steps, r * RUN + 1, RUN), start, step))
        before = lambda runs: F.aggregate(runs, F.array(F.lit(0)), lambda acc, run: F.concat(acc, F.array(F.element_at(acc, -1) + run["at"])))
        return _let(runs, lambda runs: _let(before(runs), lambda by: F.flatten(F.transform(runs, lambda run, r: moved(run, by[r])))))

    def zipped(whole: Column) -> Column:
        between = F.slice(F.transform(F.split(text, pattern, -1), lambda x: F.length(x)), 1, F.size(whole))
        value = whole if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.arrays_zip(between.alias("gap"), whole.alias("whole"), value.alias("value"))

    found = lambda whole: F.when(F.size(whole) > 0, _let(zipped(whole), placed)).otherwise(empty)
    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)


def _base(text: Column) -> Column:
    """All base spans by start and kind. Patterns that need a length are safe as they stand: a run of hexadecimal or
    capital characters that is too short holds no longer one. An assignment is matched first and measured afterwards."""
    assign = F.filter(_found(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= 6)
    return F.array_sort(F.concat(assign, _found(text, ACCESS, 1), _found(text, HEX, 2)))


def _opaque(text: Column) -> Column:
    """Runs of key characters with digits and letters of both cases; some may overlap base spans."""
    return F.filter(_found(text, KEY, 3), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"))


def _alone(candidates: DataFrame) -> DataFrame:
    """Candidates without the opaque ones that overlap a base span of their row.

    In order of start, such a span begins with or before the opaque one and ends within or after it, or it comes next:
    opaque spans do not overlap each other.
    """
    order = Window.partitionBy("row").orderBy("span.start", "span.kind")
    base = F.col("span.kind") < 3
    upto = F.max(F.when(base, F.col("span.end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.lead(F.when(base, F.col("span.start"))).over(order)
    covered = ~base & F.coalesce((upto > F.col("span.start")) | (after < F.col("span.end")), F.lit(False))
    return candidates.withColumn("covered", covered).where("not covered").drop("covered")


def _spell(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: a row id, doc_id, source, and its base and opaque spans (overlapping or not) with hashed values."""
    hashed = lambda spans: F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.unhex(F.sha2(s["value"].cast("binary"), 256)).alias("hash"))
    )
    own = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    # one pass decides for nearly every text that it holds nothing
    holds = F.col("text").rlike(f"{HEX}|{KEY}|AKIA[A-Z0-9]|{ASSIGN}")
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    own = own.withColumn("base", F.when(holds, _base(F.col("text"))).otherwise(none))
    own = own.withColumn("more", F.when(F.col("text").rlike(KEY), _opaque(F.col("text"))).otherwise(none))
    return own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", hashed(F.col("base")).alias("base"), hashed(F.col("more")).alias("more"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(of_hash, repositories, owners) of candidates (hash, source)."""
    owner = F.substring_index("source", "/", 1)
    pairs = candidates.groupBy("hash", "source").agg(F.count(F.lit(1)).alias("times")).withColumn("owner", owner)
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("times").alias("times"))
    return owners.groupBy(F.col("hash").alias("of_hash")).agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"), F.sum("times").alias("times"))


def secrets(docs: DataFrame, owners: int = OWNERS) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans, and how many spans look live or are widely copied."""
    scanned = staged(scan(docs), "secrets")
    every = F.concat("base", "more")
    candidates = scanned.where(F.size(every) > 0).select("row", "source", F.explode(every).alias("span"))
    candidates = _alone(candidates).select("row", "source", "span", F.col("span.hash").alias("hash"))
    counted = staged(ownership(candidates.select("hash", "source")), "ownership")
    judged = candidates.join(counted, F.col("hash") == F.col("of_hash"), "left").withColumn("live", F.col("owners") <= owners)
    opaque = F.when(F.col("live") & (F.col("span.kind") == 3), F.struct("span.start", "span.kind", "span.end"))
    judged = judged.groupBy(F.col("row").alias("of_row")).agg(
        F.collect_list(opaque).alias("kept"), F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied")
    )
    bare = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    rows = scanned.join(judged, F.col("row") == F.col("of_row"), "left")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    added = F.coalesce("kept", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id", *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)), F.sha2(_spell(bare).cast("binary"), 256).alias("base_sha256"),
        _spell(F.concat(bare, added)).alias("spans"), F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def _sql_found(pattern: str, kind: int, value: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    select row, start, {kind} as kind, start + length(whole) as "end", value from (
      select row, whole, value, gaps + sum(length(whole)) over (partition by row order by i) - length(whole) as start from (
        select row, i, whole, value, sum(length(gap)) over (partition by row order by i) as gaps from (
          select row, generate_subscripts(wholes, 1) as i, unnest(wholes) as whole, unnest({value}) as value, unnest(betweens[:len(wholes)]) as gap
          from (select row, regexp_extract_all(text, '{quoted}', 0) as wholes, {"regexp_extract_all(text, '" + quoted + "', 2)" if value == "inner_values" else "null"} as inner_values,
                string_split_regex(text, '{quoted}') as betweens from texts) where len(wholes) > 0)))"""


_SPELL = """string_agg(['assign', 'access', 'hex', 'opaque'][kind + 1] || ':' || start || ':' || "end", ',' order by start, kind)"""
ORACLE_SQL = f"""
with texts as (select row_number() over () as row, doc_id, source, coalesce(text, '') as text from documents),
assign as (select * from ({_sql_found(ASSIGN, 0, "inner_values")}) where length(value) >= 6),
access as ({_sql_found(ACCESS, 1, "wholes")}),
hex as ({_sql_found(HEX, 2, "wholes")}),
base as (select * from assign union all select * from access union all select * from hex),
runs as ({_sql_found(KEY, 3, "wholes")}),
opaque as (
  select * from runs where regexp_matches(value, '[0-9]') and regexp_matches(value, '[a-z]') and regexp_matches(value, '[A-Z]')
  and not exists (select 1 from base b where b.row = runs.row and b.start < runs."end" and runs.start < b."end")),
candidates as (select * from base union all select * from opaque),
owned as (
  select value, count(distinct coalesce(split_part(source, '/', 1), chr(0))) <= {OWNERS} as live
  from candidates join texts using (row) group by value),
judged as (select row, start, kind, "end", live from candidates join owned using (value)),
live as (select row, count(*) filter (live) as n_live, count(*) filter (not live) as n_copied from judged group by row),
based as (
  select row, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex, {_SPELL} as spans
  from base group by row),
kept as (select row, {_SPELL} as spans from judged where kind < 3 or live group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(based.spans, '')) as base_sha256, coalesce(kept.spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from texts left join based using (row) left join kept using (row) left join live using (row)
"""
