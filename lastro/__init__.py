"""Receivables risk analytics written as Spark DataFrame jobs."""
