"""Inventory and production-order analytics over ERP tables, as Spark DataFrame jobs."""
