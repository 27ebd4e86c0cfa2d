"""flowlake: Spark DataFrame operators over dataflow-estate tables and streams.

Typical use::

    from flowlake import build_session, Estate
    from flowlake.operators import lint

    spark = build_session()
    estate = Estate.load(spark, "/path/to/tables")
    lint.lint_report(estate.groups, estate.processors, estate.connections).show()
"""

from .session import build_session, ensure_checkpoint_dir, shared_path
from .sources.tables import Estate

__version__ = "0.1.0"

__all__ = ["build_session", "ensure_checkpoint_dir", "shared_path", "Estate", "__version__"]
