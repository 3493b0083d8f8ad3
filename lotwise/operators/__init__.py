"""DataFrame operators, parametrised by column names."""
