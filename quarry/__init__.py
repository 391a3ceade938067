"""quarry: encyclopedia-dump and comment-dump text extraction on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column ->
Column`` for text rules) built from Spark SQL expressions, so Catalyst
plans it and whole-stage codegen runs it in the JVM.
"""

from quarry.options import Options
from quarry.session import get_session, checkpoint_dir

__all__ = ["Options", "get_session", "checkpoint_dir"]
