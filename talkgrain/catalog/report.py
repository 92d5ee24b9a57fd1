"""Queries: audit reports as nested documents.

The checks take the same JSON text apart node by node and know the schema as lists of paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain import constants as K
from talkgrain import schemas
from talkgrain.catalog.conversation import CITE, last_place
from talkgrain.catalog.registry import query, step
from talkgrain.catalog.tables import Inputs
from talkgrain.operators import quality, report
from talkgrain.plans import places


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _declared(kind: T.DataType, name: str = "") -> list[str]:
    """Every field of a schema by its names from the top."""
    if isinstance(kind, T.ArrayType):
        return _declared(kind.elementType, name)
    if not isinstance(kind, T.StructType):
        return []
    inner = [(f"{name}.{f.name}" if name else f.name, f.dataType) for f in kind.fields]
    return [n for n, _ in inner] + [x for n, k in inner for x in _declared(k, n)]


def reports(t: Inputs) -> DataFrame:
    return report.read_reports(t.report)


def first_documents(t: Inputs) -> DataFrame:
    """(call_id, report) of each conversation's first turn.  The turn is chosen by its text: a report is many times as long, and one of every
    turn would be parsed and sorted.  Few bytes make much parsing, so the texts stay dealt over all partitions."""
    spoken = t.conversations
    rest = [c for c in spoken.columns if c not in ("conv_id", "turn")]
    first = spoken.groupBy("conv_id").agg(F.min("turn").alias("turn"), F.min_by(F.struct(*rest), "turn").alias("r")).select("conv_id", "turn", "r.*")
    dealt = first.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "conv_id")
    return report.read_reports(t.view("v_report", conversations=dealt)).select(F.col("of_call").alias("call_id"), "report")


# One row a node: its path, its field's names from the top, the key, and the value of a leaf.
step("s_nodes", r"""
select call_id, substr(x.fullkey, 3) as path, regexp_replace(substr(x.fullkey, 3), '\[\d+\]', '', 'g') as field, x.key, x.type, x.atom ->> '$' as val, x.fullkey like '%]' as in_list,
  regexp_replace(substr(x.path, 3), '\[\d+\]', '', 'g') as holder
from v_report r, json_tree(r.body) x
""")
_REPORT_NAMES = _declared(schemas.REPORT)
_CITED_FIELDS = [n for n in [*_REPORT_NAMES, "turn_range"] if places.last(n) in K.CITATION_FIELDS]
step("s_cited_turns", f"""
select call_id, path, string_split(field, '.')[-1] as field, try_cast(val as bigint) as turn from s_nodes where type in ('UBIGINT', 'BIGINT') and field in ({_quoted(_CITED_FIELDS)})
""")


def cited(t: Inputs) -> DataFrame:
    """Of reports, and the turn range of each as of a chunk of a long call."""
    chunks = t.report.withColumn("report", F.from_json("body", schemas.CHUNK))
    ranges = report.citations(chunks, kind=schemas.CHUNK).where(F.col("field") == "turn_range")
    return report.citations(reports(t)).unionByName(ranges)


@query("jsn_2_citations", "select call_id, path, field, turn from s_cited_turns")
def jsn_2(t: Inputs) -> DataFrame:
    return cited(t)


@query("jn_12_citation_bounds", """
select distinct c.call_id, c.turn, n as total_turns from s_cited_turns c join v_report r on r.call_id = c.call_id join (select cast(conv_id as varchar(20)) as of_call, count(*) as n from conversations group by 1) z on z.of_call = r.of_call
where c.turn <> -1 and (c.turn < 0 or c.turn >= n)
""")
def jn_12(t: Inputs) -> DataFrame:
    sizes = t.conversations.groupBy(F.col("conv_id").cast("string").alias("of_call")).agg(F.count("*").alias("total_turns"))
    return quality.beyond(cited(t), t.report.select("call_id", "of_call").join(sizes, "of_call"))


_OBJECTS = [n for n in ["", *_REPORT_NAMES] if any(x.startswith(n + "." if n else "") for x in _REPORT_NAMES)]
step("s_extra", f"""
select call_id, path from s_nodes where not in_list and path <> '' and holder in ({_quoted(_OBJECTS)}) and field not in ({_quoted(_REPORT_NAMES)})
""")


@query("jsn_1_nested_keys", "select call_id, path from s_extra")
def jsn_1_nested(t: Inputs) -> DataFrame:
    return report.unknown_keys(t.report)


@query("jsn_1_without_unknown", f"""
select n.call_id, path, type = 'OBJECT' as is_object, n.val as value from s_nodes n
where path <> '' and type <> 'NULL' and not exists (select 1 from s_extra e where e.call_id = n.call_id and (n.path = e.path or starts_with(n.path, e.path || '.') or starts_with(n.path, e.path || '[')))
""")
def jsn_1_clean(t: Inputs) -> DataFrame:
    """The documents that are left, node by node."""
    left = report.without_unknown_keys(t.report).select("call_id", F.try_parse_json("body").alias("v"))
    rows = nodes(left, 9)
    return rows.select("call_id", "path", "is_object", "value")


def nodes(documents: DataFrame, depth: int) -> DataFrame:
    """Every node of VARIANT documents that is no NULL, down to a depth."""
    rows = documents.select("call_id", F.lit("").alias("path"), "v", F.lit(True).alias("open"))
    for step in range(depth):
        # One pass: a node that was reached last stays as a row and opens into its children; a union of levels would walk down anew for each.
        twice = F.when(F.col("open"), F.array(*[F.lit(x) for x in ([False, True] if step else [True])])).otherwise(F.array(F.lit(False)))
        rows = rows.withColumn("down", F.explode(twice)).withColumnRenamed("v", "own")
        name = F.when(F.col("key").isNull(), F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key"))
        rows = rows.lateralJoin(documents.sparkSession.tvf.variant_explode_outer(F.when(F.col("down"), F.col("own")).outer()), None)
        rows = rows.select("call_id", F.when(F.col("down"), name).otherwise(F.col("path")).alias("path"), F.when(F.col("down"), F.col("value")).otherwise(F.col("own")).alias("v"), F.col("down").alias("open"))
        rows = rows.where("v is not null and not is_variant_null(v)")
    kind = F.schema_of_variant("v")
    leaf = ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY")
    return rows.select("call_id", "path", kind.startswith("OBJECT").alias("is_object"), F.when(leaf, F.try_variant_get("v", "$", "string")).alias("value"))


# --- trims, scrubs ----------------------------------------------------------------------
_CAPPED = {n: report.cap_of(n) for n, k in places.leaves(schemas.REPORT) if isinstance(k, T.StringType) and report.cap_of(n)}
step("s_capped", "select * from (values " + ", ".join(f"('{n}', {cap})" for n, cap in _CAPPED.items()) + ") x(field, cap)")
step("s_over", "select call_id, path, n.field, val, cap from s_nodes n join s_capped c on c.field = n.field where type = 'VARCHAR' and length(val) > cap")


@query("str_8_trim_log", f"""
select call_id, path, field, length(val) as was, cast(cap as bigint) as cap, case when a >= cap // 2 then trim(left(head, a + 1)) when b >= cap // 2 then trim(left(head, b + 1)) when c >= cap // 2 then trim(left(head, c + 1))
    else left(concat(rtrim(case when s >= cap // 2 then left(head, s) else left(head, cap - 1) end, ' ,;:-—–'), '…'), cap) end as text
from (select *, {last_place('. ')} as a, {last_place('! ')} as b, {last_place('? ')} as c, {last_place(' ')} as s from (select *, left(val, cap) as head from s_over) x) y
""")
def str_8_log(t: Inputs) -> DataFrame:
    """What was cut where, and what stands there afterwards."""
    return report.trimmed(reports(t)).select("call_id", F.explode("trims").alias("l")).select("call_id", "l.*")


_SUMMARY_TEXTS = [n for n, k in places.leaves(schemas.REPORT) if n.startswith("sales_summary.")]
step("s_scrubbed", rf"""
select call_id, path, field, case when cut = val then val else concat(replace(upper(left(tidy, 1)), 'ẞ', 'SS'), substr(tidy, 2)) end as text, cut <> val as scrubbed from (
  select *, trim(regexp_replace(regexp_replace(cut, '\s{{2,}}', ' ', 'g'), '\s+([,.;:])', '\1', 'g')) as tidy from (
    select call_id, path, field, val, regexp_replace(val, '{CITE}', ' ', 'g') as cut from s_nodes where type = 'VARCHAR' and field in ({_quoted(_SUMMARY_TEXTS)})) a) b
""")


@query("str_9_scrub_log", "select call_id, path, text, scrubbed from s_scrubbed")
def str_9_log(t: Inputs) -> DataFrame:
    """Every text of the sales summary afterwards, and whether the log names it."""
    clean = report.scrubbed(reports(t))
    texts = places.gathered(F.col("report"), schemas.REPORT, lambda n, k: n in _SUMMARY_TEXTS, lambda path, n, v: F.struct(path.alias("path"), v.alias("text")))
    return clean.select("call_id", "scrubs", F.explode(texts).alias("x")).where("x.text is not null").select("call_id", "x.path", "x.text", F.array_contains("scrubs", F.col("x.path")).alias("scrubbed"))


# --- the schema's own rules -----------------------------------------------------------------
_ENUMS = " or ".join(f"(field = '{n}' and val not in ({_quoted(K.ENUMS[kind])}))" for n, kind in K.ENUM_FIELDS.items())
_KINDS = dict(places.leaves(schemas.REPORT))
_NUMBERS = [(n, K.NUMBER_BOUNDS[places.last(n)]) for n, k in _KINDS.items() if places.last(n) in K.NUMBER_BOUNDS and not isinstance(k, T.StringType)]
_RANGES = " or ".join(f"(field = '{n}' and ({' or '.join([f'cast(val as double) < {low}'] * (low is not None) + [f'cast(val as double) > {high}'] * (high is not None))}))" for n, (low, high) in _NUMBERS)
_SIZES = [(n, K.LIST_BOUNDS[places.last(n)]) for n in report._LISTS if places.last(n) in K.LIST_BOUNDS and n not in K.UNCAPPED_FIELDS]
_SIZED = ", ".join(f"('{n}', {low}, {high})" for n, (low, high) in sorted(_SIZES))


@query("dq_1_report_enums", f"select call_id, path, 'enum' as rule from s_nodes where type = 'VARCHAR' and ({_ENUMS})")
def dq_1_report(t: Inputs) -> DataFrame:
    return report.violations(reports(t)).where(F.col("rule") == "enum")


@query("dq_2_report_ranges", f"select call_id, path, 'range' as rule from s_nodes where type in ('UBIGINT', 'BIGINT', 'DOUBLE') and ({_RANGES})")
def dq_2_report(t: Inputs) -> DataFrame:
    return report.violations(reports(t)).where(F.col("rule") == "range")


@query("dq_3_report_sizes", f"""
select r.call_id, b.field as path, 'size' as rule from v_report r cross join (values {_SIZED}) b(field, low, high)
left join (select call_id, holder, count(*) as n from s_nodes where in_list group by 1, 2) s on s.call_id = r.call_id and s.holder = b.field where coalesce(n, 0) not between low and high
""")
def dq_3_report(t: Inputs) -> DataFrame:
    return report.violations(reports(t)).where(F.col("rule") == "size")


@query("dq_4_report_caps", "select call_id, path, case when in_list then 'item_length' else 'length' end as rule from (select o.*, path like '%]' as in_list from s_over o) x")
def dq_4_report(t: Inputs) -> DataFrame:
    return report.violations(reports(t)).where(F.col("rule").isin("length", "item_length"))
