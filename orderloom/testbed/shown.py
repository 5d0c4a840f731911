"""What the query over stored reports shows of each, in Spark and in SQL."""

# What is shown of each stored report: a label and an amount.
SHOWN = {
    "most_valuable_customers": ("customer_unique_id", "total_spent"),
    "rolling_quarters": ("customer_unique_id", "rolling_quartal_avg"),
    "top_ten_products_q_sales": ("product_id", "total_quarter_sales"),
    "top_ten_products_q_by_category": ("product_id", "total_sales"),
    "raise_sales_gradient": ("product_category", "growth_percentage"),
    "cumulative_product_sales": ("product_id", "dec"),
    "daily_rebates": (None, "daily_rebates"),
    "daily_avgs_states_comparison": ("state", "current_avg_order_value"),
    "seller_rating": ("seller_id", "performance_rank"),
    "orders_avg_period": ("customer_unique_id", "interval_seconds"),
    "trend_products_by_seller": ("product_id", "orders_count"),
}
