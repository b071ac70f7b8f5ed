"""The registered queries, each with the SQL that must give the same rows where SQL can."""

from rowloom.plans import (  # noqa: F401  (importing a module registers its queries)
    conversations,
    documents,
    evaluation,
    inference,
    relational,
    streams,
    tables,
    vectors,
)
from rowloom.plans.registry import ORACLES, QUERIES  # noqa: F401
