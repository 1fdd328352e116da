"""Spark-native operators that turn a landed corpus of legal documents into
research-ready tables: works, text units and relations."""
