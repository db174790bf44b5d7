"""Readers and writers: landed JSON pages, delimited text, CSV zones, Kafka topics and JDBC tables."""
