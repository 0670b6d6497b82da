"""Star schema, KPI and cohort queries, and the stages that store them."""
