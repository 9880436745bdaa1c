"""The two analyses built from the operators, keyed for registration."""

from tallyframe.plans.tickets import QUERIES as TICKET_QUERIES
from tallyframe.plans.trips import QUERIES as TRIP_QUERIES

QUERIES = {**TRIP_QUERIES, **TICKET_QUERIES}

__all__ = ["QUERIES", "TICKET_QUERIES", "TRIP_QUERIES"]
