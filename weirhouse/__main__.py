"""Run one job: ``spark-submit -m weirhouse <job> <settings.json>``.

Settings: ``servers`` (Kafka) or ``root`` (folder of file topics), and
``checkpoint``; ``store`` for the dimension tables and ``database``, whose tables follow the rules, where wanted; ``jdbc`` (``url``, ``table``,
``driver``) or ``stats`` (folder) for the visitor statistics; ``cdc_topics``, the
pattern of the connector's topics; ``groups``, a consumer group by job; ``once`` to take what is there and stop.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirhouse import schemas
from weirhouse.operators import dims as dim_ops
from weirhouse.operators import routing
from weirhouse.session import get_spark
from weirhouse.sources import dim_store
from weirhouse.sources.jdbc import write_jdbc
from weirhouse.sources.topics import TopicSpec
from weirhouse.streaming import jobs

# The topic names the jobs hand records over with.
RAW_LOG = "ods_base_log"
RAW_CHANGES = "ods_base_db"
RULE_CHANGES = "ods_config_db"
START_LOG = "dwd_start_log"
PAGE_LOG = "dwd_page_log"
DISPLAY_LOG = "dwd_display_log"
ORDER_INFO = "dwd_order_info"
ORDER_DETAIL = "dwd_order_detail"
PAYMENT_INFO = "dwd_payment_info"
UNIQUE_VISIT = "dwm_unique_visit"
BOUNCE = "dwm_user_jump_detail"
ORDER_WIDE = "dwm_order_wide"
PAYMENT_WIDE = "dwm_payment_wide"

# Names of our own: what the jobs could not pass on.
DIRTY_LOG = "dirty_log"
UNROUTED = "unrouted_changes"

# File topics written together by one job share a folder.
SHARED = {START_LOG: "dwd_log", PAGE_LOG: "dwd_log", DISPLAY_LOG: "dwd_log"}
SHARED |= {ORDER_INFO: "dwd_db", ORDER_DETAIL: "dwd_db", PAYMENT_INFO: "dwd_db"}


class Settings:
    def __init__(self, spark: SparkSession, values: dict):
        self.spark, self.values = spark, values
        self.trigger = {"availableNow": True} if values.get("once") else jobs.EVERY

    def topic(self, name: str, group: str | None = None) -> TopicSpec:
        if "root" in self.values:
            folder = SHARED.get(name, name)
            return TopicSpec(name, path=f"{self.values['root']}/{folder}", shared=name in SHARED)
        return TopicSpec(name, servers=self.values["servers"], group=group)

    def checkpoint(self, job: str) -> str:
        return f"{self.values['checkpoint']}/{job}"

    def connector_messages(self) -> DataFrame:
        """Messages of the change connector with the name of their topic."""
        if "root" in self.values:
            reader = self.spark.readStream.schema("topic string, value string")
            return reader.parquet(f"{self.values['root']}/connector")
        reader = self.spark.readStream.format("kafka").option("kafka.bootstrap.servers", self.values["servers"])
        rows = reader.option("subscribePattern", self.values["cdc_topics"]).load()
        # a delete is followed by a message without a value
        return rows.filter("value IS NOT NULL").select("topic", F.col("value").cast("string").alias("value"))

    def dims(self) -> dict[str, DataFrame]:
        """The six dimension tables as the store has them now."""
        rules = routing.store_rows(jobs.rule_history_of_topic(self.spark, self.topic(RULE_CHANGES)))
        tables = {name.lower(): t for name, t in dim_store.store_tables(rules, jobs.RULE_ORDER).items()}
        wanted = [spec.table for spec in dim_ops.order_dims(0)]
        missing = [name for name in wanted if name not in tables]
        if missing:
            raise ValueError(f"no rule fills {missing}")
        return {name: dim_store.read(self.spark, self.values["store"], tables[name]) for name in wanted}

    def write_stats(self, rows: DataFrame, batch_id: int) -> None:
        if "jdbc" in self.values:
            write_jdbc(rows, columns=schemas.VISITOR_STATS, **self.values["jdbc"])
        else:
            rows.write.mode("overwrite").parquet(f"{self.values['stats']}/batch={batch_id}")


def start(job: str, s: Settings):
    spark, topic, ck, trigger = s.spark, s.topic, s.checkpoint(job), s.trigger
    group = s.values.get("groups", {}).get(job, f"weirhouse-{job}")
    starters = {
        "sync-changes": lambda: jobs.sync_changes(s.connector_messages(), topic(RAW_CHANGES), ck, trigger),
        "split-logs": lambda: jobs.split_logs(
            spark, topic(RAW_LOG, group), topic(PAGE_LOG), ck, START_LOG, PAGE_LOG, DISPLAY_LOG, trigger
        ),
        "dirty-logs": lambda: jobs.keep_dirty_logs(spark, topic(RAW_LOG, group), topic(DIRTY_LOG), ck, trigger),
        "unrouted-changes": lambda: jobs.count_unrouted(
            spark,
            topic(RAW_CHANGES, group),
            lambda: jobs.rules_of_topic(spark, topic(RULE_CHANGES)),
            topic(UNROUTED),
            ck,
            trigger,
        ),
        "route-changes": lambda: jobs.route_changes(
            spark,
            topic(RAW_CHANGES, group),
            lambda: jobs.rule_history_of_topic(spark, topic(RULE_CHANGES)),
            topic(ORDER_INFO),
            s.values["store"],
            ck,
            trigger,
            as_of=True,
            database=s.values.get("database"),
        ),
        "unique-visits": lambda: jobs.find_unique_visits(
            spark,
            topic(PAGE_LOG, group),
            topic(UNIQUE_VISIT),
            ck,
            s.values.get("unique_mode", "day"),
            trigger=trigger,
        ),
        "bounces": lambda: jobs.find_bounces(
            spark, topic(PAGE_LOG, group), topic(BOUNCE), ck, trigger=trigger
        ),
        "order-wide": lambda: jobs.widen_orders(
            spark,
            topic(ORDER_INFO, group),
            topic(ORDER_DETAIL, group),
            s.dims,
            topic(ORDER_WIDE),
            ck,
            trigger=trigger,
        ),
        "payment-wide": lambda: jobs.widen_payments(
            spark,
            topic(PAYMENT_INFO, group),
            topic(ORDER_WIDE, group),
            topic(PAYMENT_WIDE),
            ck,
            trigger=trigger,
        ),
        "visitor-stats": lambda: jobs.count_visitors(
            spark,
            topic(PAGE_LOG, group),
            topic(UNIQUE_VISIT, group),
            topic(BOUNCE, group),
            s.write_stats,
            ck,
            trigger=trigger,
        ),
    }
    if job not in starters:
        raise SystemExit(f"unknown job {job!r}; one of {', '.join(starters)}")
    return starters[job]()


def main(argv: list[str]) -> None:
    if len(argv) != 2:
        raise SystemExit(__doc__)
    with open(argv[1]) as f:
        values = json.load(f)
    spark = get_spark(f"weirhouse-{argv[0]}")
    start(argv[0], Settings(spark, values)).awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
