"""Evaluation analyses."""

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from . import inputs as I
from .catalog import register


@register("e1_precision_by_threshold", f"""
with s as ({I.SCORES_SQL}),
g as (select score as threshold, sum(label) as pos, count(*) as cnt from s group by score),
c as (select threshold,
        sum(pos) over (order by threshold desc rows between unbounded preceding and current row) as tp,
        sum(cnt) over (order by threshold desc rows between unbounded preceding and current row) as predicted
      from g)
select threshold, cast(tp as bigint) as tp, cast(predicted as bigint) as predicted,
       round(tp / predicted, 6) as precision from c
""")
def e1_precision_by_threshold(spark, sf_dir):
    r = ev.precision_by_threshold(I.scores(spark, sf_dir))
    return r.select("threshold", "tp", "predicted", F.round("precision", 6).alias("precision"))
