"""Structured Streaming form of the incremental Bronze load."""

from tillroll.streaming.incremental import start_orders_stream

__all__ = ["start_orders_stream"]
