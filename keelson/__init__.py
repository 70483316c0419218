"""keelson: parameterised PySpark operators for business tables, event logs
and change-data feeds.

Every operator is a plain ``DataFrame -> DataFrame`` transform built from the
DataFrame API so Catalyst can prune, push down and plan it; the few places
that need Python state use Arrow-batched pandas handlers.
"""

from keelson.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
