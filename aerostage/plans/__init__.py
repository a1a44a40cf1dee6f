"""Composed plans: staging models, data checks, store helpers, KPIs."""
