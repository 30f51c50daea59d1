"""Plans built from the operators: daily batch, warehouse load, serving queries,
dashboard reports, and the SQL oracles used for verification."""
