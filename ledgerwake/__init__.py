"""Trading analytics on Spark: feeds in, positions, value, PnL and risk series out."""

from ledgerwake.params import Params
from ledgerwake.session import build_session

__all__ = ["Params", "build_session"]
