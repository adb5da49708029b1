"""seqintel: forum text -> behaviour sequences -> HMM next-phase analytics, on Spark."""

__version__ = "0.1.0"
