"""Column-expression helpers. Everything here stays inside whole-stage codegen."""

from runlens.functions.maps import key_params_json, lower_keys
from runlens.functions.stats import epoch_seconds, latest_non_null, nan_to_null, round6, safe_corr
from runlens.functions.status import health_status, run_status, threshold_source

__all__ = [
    "epoch_seconds", "health_status", "key_params_json", "latest_non_null", "lower_keys",
    "nan_to_null", "round6", "run_status", "safe_corr", "threshold_source",
]
