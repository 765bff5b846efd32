"""Lead-to-engagement analytics as plain Spark jobs.

Every public function takes DataFrames (plus literal parameters) and returns a
DataFrame; nothing here owns a session, caches globally or collects rows.
"""

__version__ = "0.1.0"
