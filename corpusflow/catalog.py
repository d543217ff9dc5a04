"""Query name -> callable, and query name -> SQL, for everything but the training-data operators."""

from __future__ import annotations

from .plans import files, more, queries

QUERIES = dict(queries.QUERIES)
ORACLES = dict(queries.ORACLES)
#: Queries that need Python workers: files, models, archives, word alignment, the fold over sorted segments and products of whole blocks are opaque to the JVM.
PYTHON = {"rover_vote", "single_speaker_timeline", "wide_correlations", *more.PYTHON, *files.PYTHON}
