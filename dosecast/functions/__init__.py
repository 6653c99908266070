"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from dosecast.functions.months import (  # noqa: F401
    brand_no, datekey_of, fold_month, lenient_date, mi_first_day, mi_last_day,
    mi_of, mi_of_yyyymm, yyyymm_of_mi)
from dosecast.functions.scalars import (  # noqa: F401
    guarded_ratio, half_even, r6, safe_div)
