"""graphloom: document-to-graph analytics as declarative Spark plans.

Sub-packages: ``sources`` (readers, sinks), ``functions`` (column functions),
``operators`` (DataFrame -> DataFrame), ``plans`` (registered queries and their
SQL), ``streaming`` (incremental variants) and, optionally, ``llm`` (training
data operators; nothing else imports it).
"""
