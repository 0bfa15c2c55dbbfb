"""The registered queries: a Spark run and, where SQL can say it, the same in ANSI SQL."""

from dataclasses import replace

from dimstar.registry.dimension_queries import QUERIES as _dimensions
from dimstar.registry.fact_queries import QUERIES as _facts
from dimstar.registry.io_queries import QUERIES as _io
from dimstar.registry.quality_queries import QUERIES as _quality
from dimstar.registry.relational_queries import QUERIES as _relational
from dimstar.registry.report_queries import QUERIES as _reports

_BUILDERS = [replace(q, from_raw=True) for q in [*_dimensions, *_facts, *_quality]]
QUERIES = {q.name: q for q in [*_reports, *_relational, *_BUILDERS, *_io]}
