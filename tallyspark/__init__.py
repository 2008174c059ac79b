"""Position reconciliation, event-window analytics and break investigation on Spark."""
