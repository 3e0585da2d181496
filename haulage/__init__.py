"""haulage: freight and logistics analytics as Spark DataFrame transforms.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``Column``
expression) built on the DataFrame/SQL API, so Catalyst plans it and
Tungsten runs it. See README.md for the module map.
"""

from haulage.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
