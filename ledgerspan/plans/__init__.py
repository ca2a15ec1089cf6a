"""Plans: staging tables, curated tables, quality controls, analytic views and business rules."""
