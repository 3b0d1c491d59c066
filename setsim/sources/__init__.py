from setsim.sources import readers, writers

__all__ = ["readers", "writers"]
