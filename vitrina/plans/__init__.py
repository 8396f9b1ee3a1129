"""Query plans: registered queries, their SQL twins, and the daily runs."""
