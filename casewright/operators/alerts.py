"""From queue to outbox: eligibility, recent-send suppression, rendering and the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions.messages import alert_body, alert_subject
from casewright.operators.joins import assign, suppress_recent

REASONS = ["top_risk_factor_1", "top_risk_factor_2", "top_risk_factor_3"]
ERROR_LENGTH = 2000


def eligible(queue: DataFrame, predicted: str = "predicted", least: float = 0.70) -> DataFrame:
    return queue.where((F.col(predicted) == 1) & (F.col("risk_score") >= least))


def recent_sends(
    log: DataFrame, keys: list[str], as_of: Column, hours: int = 48,
    status: str = "sent_status", sent: str | tuple[str, ...] = "sent", stamp: str = "sent_ts",
) -> DataFrame:
    """Distinct keys with a successful send in the look-back window (its start included).

    ``sent`` is the status, or the statuses, that count as sent.
    """
    start = as_of.cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return log.where((F.col(status).isin(*([sent] if isinstance(sent, str) else sent))) & (F.col(stamp) >= start)).select(*keys).dropDuplicates()


def pending_alerts(
    queue: DataFrame, assignments: DataFrame, log: DataFrame, as_of: Column,
    key: str = "entity_id", recipient: str = "counselor_email", predicted: str = "predicted",
    hours: int = 48, least: float = 0.70,
) -> DataFrame:
    """Eligible entities with an active assignee who was not told within the look-back window.

    An alert that waits in the outbox counts as told, so a second run within the window queues nothing twice.
    """
    due = assign(eligible(queue, predicted, least), assignments, key)
    told = recent_sends(log, [key, recipient], as_of, hours, sent=("sent", "pending"))
    return suppress_recent(due, told, [key, recipient])


def render_alerts(
    pending: DataFrame, key: str = "entity_id", name: str = "counselor_name", queued_at: str = "queue_ts"
) -> DataFrame:
    shown = F.round("risk_score", 3)  # half up on the printed digits
    return pending.withColumns(
        {
            "alert_subject": alert_subject(key, shown),
            "alert_body": alert_body(name, key, shown, "recommended_action", REASONS, queued_at),
        }
    )


def outbox_rows(
    rendered: DataFrame, as_of: Column, status: Column | None = None, error: Column | None = None,
    key: str = "entity_id", recipient: str = "counselor_email",
) -> DataFrame:
    """The twelve log columns. Delivery is up to whoever reads the outbox; the default is ``pending``."""
    return rendered.select(
        key, recipient, "risk_score", "recommended_action", *REASONS, "alert_subject", "alert_body",
        (status if status is not None else F.lit("pending")).alias("sent_status"),
        F.substring(error if error is not None else F.lit(None).cast("string"), 1, ERROR_LENGTH).alias("sent_error"),
        as_of.cast("timestamp").alias("sent_ts"),
    )


def recent_log(log: DataFrame, n: int = 50, tie: str = "entity_id") -> DataFrame:
    """The newest log entries."""
    return log.orderBy(F.col("sent_ts").desc(), F.col(tie).asc()).limit(n)
