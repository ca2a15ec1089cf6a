"""Analytic views, KPIs and dashboard queries over the curated tables."""
