"""Job parameters."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

# Published defaults of the job this library re-implements.
PSI_NONE_BELOW = 0.10
PSI_HALT_AT = 0.25
PSI_EMPTY_BIN_SHARE = 0.0001
PSI_DECIMALS = 4
PSI_BINS = 10
MIN_ROC_AUC = 0.60
MIN_ROW_COUNT = 1
BASELINE_START = dt.date(2022, 1, 1)
BASELINE_END = dt.date(2022, 1, 15)
REPLAY_START = dt.date(2022, 2, 1)
REPLAY_DAYS = 28
EVAL_SHARE = 0.20
HIGH_TIP_ABOVE = 2.0
LEAK_RULE_ABOVE = 5.5
FARE_MIN = 2.50
FARE_MAX = 100.00
CARD_PAYMENT = "1"
EXIT_OK = 0
EXIT_HALTED = 2
EXIT_FAILED = 3
ALERT_WINDOW_S = 300
ALERT_COUNTER_ABOVE = 300_000
NOTIFY_GAP_S = 300
LOG_INCIDENT_CLOSE_S = 1_800
METRIC_INCIDENT_CLOSE_S = 86_400
LATE_AFTER_S = 600
COUNTER_IDLE_S = 30 * 86_400
RUN_SUMMARY_EVENT = "pipeline_run_summary"
ABNORMAL_EXIT = r"Container called exit[(](1|[4-9]|[1-9][0-9]+)[)]"
KILLED = r"(?i)terminated on signal|memory limit"


def _as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value.strip())


@dataclass(frozen=True)
class JobConfig:
    """Everything a run needs to know; typed values, never spliced into SQL text."""

    target_date: dt.date | str | None = None
    baseline_start: dt.date | str = BASELINE_START
    baseline_end: dt.date | str = BASELINE_END
    eval_label_lag_days: int = 0
    psi_threshold: float = PSI_HALT_AT
    canary_feature: str = "fare_amount"
    min_roc_auc: float = MIN_ROC_AUC
    min_row_count: int = MIN_ROW_COUNT
    min_baseline_rows: int = 0
    enable_replay_ingest: bool = True
    source_table: str = "source_trips_2022"
    replay_start: dt.date | str = REPLAY_START
    replay_days: int = REPLAY_DAYS
    features_table: str = "trip_features"
    feature_view: str = "trip_feature_view"
    predictions_table: str = "trip_predictions"
    ledger_table: str = "run_ledger"
    metrics_table: str = "run_metrics"
    logs_table: str = "run_logs"
    registry_table: str = "model_registry"
    model_name: str = "tip_model"
    table_root: str | None = None

    def __post_init__(self):
        for name in ("baseline_start", "baseline_end", "replay_start"):
            object.__setattr__(self, name, _as_date(getattr(self, name)))
        if self.eval_label_lag_days < 0:
            raise ValueError("eval_label_lag_days must not be negative")
        if self.min_row_count < 0:
            raise ValueError("min_row_count must not be negative")
        if self.replay_days < 1:
            raise ValueError("replay_days must be at least 1")
        if self.enable_replay_ingest:
            self._check_replay_year()

    def _check_replay_year(self):
        """A yearly source table can only feed a replay window of its own year."""
        suffix = re.search(r"\d{4}$", self.source_table.rstrip())
        if suffix and int(suffix.group()) != self.replay_start.year:
            raise ValueError(
                f"source table {self.source_table!r} holds year {suffix.group()} but the "
                f"replay window starts {self.replay_start}: it would select no rows"
            )

    @property
    def target(self) -> dt.date:
        """Partition to score; yesterday (UTC) when unset or blank."""
        given = self.target_date
        if isinstance(given, str) and not given.strip():
            given = None
        if given is None:
            return dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
        return _as_date(given)

    @property
    def eval_date(self) -> dt.date:
        """Newest partition whose labels have matured."""
        return self.target - dt.timedelta(days=self.eval_label_lag_days)
