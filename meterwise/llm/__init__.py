"""Operators of a large-scale training-data pipeline. Nothing outside this
package imports it; ``queries.py`` lists the queries the entry module adds."""
