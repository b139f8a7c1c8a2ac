"""Cohort look-back features and risk scores as Spark DataFrame operators."""
