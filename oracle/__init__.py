from oracle.build import oracle_queries

__all__ = ["oracle_queries"]
