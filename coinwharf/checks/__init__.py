"""The library's operators bound to the benchmark tables, with SQL that must agree."""
