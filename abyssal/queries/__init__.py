"""Named queries over the given tables, each with the SQL that checks it."""

from abyssal.queries import averages, control, domain, logs, quality, scalars, sequences  # noqa: F401
from abyssal.queries.base import QUERIES, SQL  # noqa: F401
