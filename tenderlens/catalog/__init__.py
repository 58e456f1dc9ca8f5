"""Runnable queries over the given tables, each with an SQL text that states its result."""

from tenderlens.catalog import stage_one, stage_three, stage_two

QUERIES = {**stage_one.QUERIES, **stage_two.QUERIES, **stage_three.QUERIES}
