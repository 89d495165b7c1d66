"""Plans: registered queries, their SQL twins and multi-step jobs."""
