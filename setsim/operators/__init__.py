from setsim.operators import conform, fingerprint, mart, quality, similarity

__all__ = ["conform", "fingerprint", "mart", "quality", "similarity"]
