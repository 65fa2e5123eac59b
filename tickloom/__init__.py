"""Market-data operators for Spark: selection, symbology, point-in-time views,
bars, feed quality, exports and streams, all as DataFrame plans."""

from tickloom.session import configure, local_session, shared_dir

__all__ = ["configure", "local_session", "shared_dir"]
