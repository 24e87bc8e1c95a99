"""DataFrame operators: joins, unions, windows, profiles, statistics, models."""
