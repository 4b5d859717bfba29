"""User-facing views.  Each is a pure function from DataFrames to a DataFrame.

Inputs use the canonical columns of ``tillroll.sources.exports``.  Time never
comes from the wall clock: views that look back from "today" take ``as_of``.
"""

from tillroll.plans.baskets import (  # noqa: F401
    bought_together, bought_together_basket_arrays, bought_together_monthly, shared_orders,
)
from tillroll.plans.customers import (  # noqa: F401
    customer_profile, customer_score_attach, customer_value_segment, day_hour_profile,
    global_averages, known_customers, order_frequency_histogram, order_gap, order_gap_rows,
    recency,
)
from tillroll.plans.fulfilment import unfulfilled_by_day, unfulfilled_by_month  # noqa: F401
from tillroll.plans.products import (  # noqa: F401
    product_cmgr, product_month_dense, product_month_revenue, product_series,
    product_week_revenue,
)
from tillroll.plans.reports import (  # noqa: F401
    daily_sales_summary, product_growth_report, revenue_by_type_long,
)
from tillroll.plans.retention import customer_retention  # noqa: F401
from tillroll.plans.weekly import (  # noqa: F401
    customer_week_profile, population_averages, weekly_basket, weekly_visits,
)
