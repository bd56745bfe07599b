"""Readers: driver test tables mapped onto the shop model, files, JDBC, lake."""
