"""Operators of a training-data pipeline.

Each module holds one operator with its own general interface; the thin
``opN_<name>`` queries that apply them to the whole test tables are in
``queries.py``, their DuckDB SQL in ``sql.py``.  Nothing outside this
package (and ``corpus_pipeline.py``) imports it.
"""
