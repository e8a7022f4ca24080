"""Named queries over one large log, written as a file, read by ranges and checked by blocks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import lookups, sequences
from lectern.plans.catalogue import query
from lectern.plans.checks import _line, _value
from lectern.session import shared_folder, table
from lectern.sources import contract

#: Lines in a block, few enough for several blocks on small tables.
BLOCK = 64


def _one_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as one log, a turn a record: every seventeenth a setting, which has no place among entries. Wrong
    are the ordinal of each eleventh turn and the sequence of each thirteenth; two artifacts overlap, and there is
    no footer. Written as text, a line a record, and read by contract.read."""
    turns = table(spark, sf_dir, "conversations")
    name = lambda at, more=0: (F.col("n") + at + F.when(F.col("turn") % 13 == 7, more).otherwise(0)).cast("long")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("c"), F.count_if(F.col("turn") % 17 == 3).alias("s"))
    before = sequences.scanned(sizes.select("conv_id", F.col("c").alias("of"), F.col("s").alias("settings")), [], "conv_id", F.floor(F.col("conv_id") / 4096), {"c": F.col("of"), "s": F.col("settings")}).select("conv_id", "c", "s")
    own = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    setting = F.col("turn") % 17 == 3
    placed = turns.join(lookups.small(before), "conv_id").withColumn("n", F.col("c") + F.count("*").over(own)).withColumn("k", F.col("s") + F.count_if(setting).over(own))
    ordinal = F.when(setting, F.col("k")).otherwise(F.col("n") - F.col("k")) + F.when(F.col("turn") % 11 == 5, 1).otherwise(0)
    rows = placed.select(name(2).alias("line_no"), F.when(setting, _line("config_entry", sequence=name(2, 5), ordinal=ordinal, name=_value(F.col("role")), value=_value(F.col("text")))).otherwise(_line("entry", sequence=name(2, 5), ordinal=ordinal, raw=_value(F.col("text")))).alias("line"))
    last = F.lit(turns.count()).cast("long")
    head = _line("header", sequence=0, contract="c", contract_version=1, command="extract", producer="p", producer_version="1", sword_version="1")
    begin = lambda k: _line("artifact_begin", sequence=last + 2 + k, artifact_id=k, file_type="regular", path=_value(F.lit("a")))
    ends = [(F.lit(0), head), (F.lit(1), _line("module", sequence=1, classification="bible", name=_value(F.lit("M"))))] + [(last + 2 + k, begin(k)) for k in (0, 1)]
    more = spark.range(1).select(F.explode(F.array(*[F.struct(at.cast("long").alias("line_no"), x.alias("line")) for at, x in ends])).alias("x")).select("x.*")
    folder = f"{shared_folder(spark).rstrip('/')}/log-{uuid.uuid4().hex}"
    rows.union(more).repartition(1).sortWithinPartitions("line_no").select("line").write.text(folder)
    return contract.read(spark, folder)


PLACES = """t AS (SELECT conv_id, turn, role, text, row_number() OVER (ORDER BY conv_id, turn) + 1 AS line_no, turn % 17 = 3 AS setting FROM conversations), l AS (SELECT max(line_no) AS last FROM t)"""


@query(f"""
WITH {PLACES}, e AS (SELECT *, min(CASE WHEN NOT setting THEN line_no END) OVER () AS first FROM t)
SELECT line_no, 'sequence' AS rule FROM t WHERE turn % 13 = 7 UNION ALL SELECT line_no, 'ordinal' FROM t WHERE turn % 11 = 5
UNION ALL SELECT line_no, 'order' FROM e WHERE setting AND line_no > first
UNION ALL SELECT last + 2, 'artifact overlap' FROM l UNION ALL SELECT last + 2, unnest(['missing footer', 'open artifact']) FROM l
""")
def log_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules of one log of all conversations, checked by blocks of lines."""
    return contract.violations(_one_log(spark, sf_dir), block=BLOCK).select("line_no", "rule")


@query(f"""
WITH {PLACES}
SELECT line_no, CASE WHEN setting THEN 'config_entry' ELSE 'entry' END AS type, true AS ended, true AS valid, sha256(text) AS sha FROM t
UNION ALL SELECT unnest([0, 1]), unnest(['header', 'module']), true, true, NULL UNION ALL SELECT last + unnest([1, 2]), 'artifact_begin', true, true, NULL FROM l
""")
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log's lines, numbered across its ranges: their types, and the hashes of what they hold."""
    r = F.col("record")
    return _one_log(spark, sf_dir).select("line_no", r["type"].alias("type"), "ended", "valid", F.coalesce(r["raw"]["sha256"], r["value"]["sha256"]).alias("sha"))
