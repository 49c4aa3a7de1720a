"""Tributary: incremental purchasing-to-payment data work on Spark, plus corpus operators in ``tributary.llm``."""
