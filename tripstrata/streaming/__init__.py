from tripstrata.streaming.incremental import load_arrivals

__all__ = ["load_arrivals"]
