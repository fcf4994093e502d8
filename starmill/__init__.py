"""starmill: raw postings -> merged history -> clean typed table -> star schema, as Spark plans."""

from starmill.session import configure, local_session

__all__ = ["configure", "local_session"]
