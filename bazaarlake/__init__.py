"""Retail lakehouse analytics written as plain Spark DataFrame plans.

Every transform is ``DataFrame(s) -> DataFrame``: it reads nothing, writes
nothing and collects nothing. Reading, writing and registering tables live in
``bazaarlake.sources``; file-drop streams in ``bazaarlake.streaming``.
"""
