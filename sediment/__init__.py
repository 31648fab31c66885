"""sediment: a layered (landing -> bronze -> silver) batch analytics engine on PySpark.

Every operator is a ``DataFrame -> DataFrame`` (or ``-> Column``) function built from
Spark's own DataFrame API, so Catalyst plans, prunes and pushes down the whole chain.
"""

from sediment.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
