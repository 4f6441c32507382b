"""Star-schema plans: date dimension, fact, revenue KPIs, dashboard queries, the warehouse."""
