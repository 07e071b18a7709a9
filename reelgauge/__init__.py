"""Video-engagement analytics on Spark: bronze JSON to silver tables to gold days to KPIs."""
