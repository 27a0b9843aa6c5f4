"""tally: lending ledger and loan reports as Spark DataFrame pipelines."""

from tally.session import build_session, checkpoint_dir, configure

__all__ = ["build_session", "checkpoint_dir", "configure"]
