"""Training-data operators: deduplication, filtering, language, licences and tokens.

Nothing else in the library imports this subpackage. Its registered queries are in
``cabstar.llm.queries``; each operator module has a general DataFrame interface and the
query derives its contract columns from that.
"""
