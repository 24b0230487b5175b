"""Enrolment analytics on Spark: register, behaviour logs, documents, statistics and models."""
