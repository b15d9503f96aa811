"""DataFrame to DataFrame operators: normalising, blocking, features, validation, profiling, splitting, decisions."""
