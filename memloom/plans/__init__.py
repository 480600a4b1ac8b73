"""Operators bound to tables, each with its SQL where SQL can say it."""

from memloom.plans import measures, routing, sequences, service, texts

QUERIES = routing.QUERIES | texts.QUERIES | sequences.QUERIES | measures.QUERIES | service.QUERIES
ORACLE_SQL = routing.ORACLE_SQL | texts.ORACLE_SQL | sequences.ORACLE_SQL | measures.ORACLE_SQL | service.ORACLE_SQL
