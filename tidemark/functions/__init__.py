"""Pure functions: names, types, sizes, and Column expressions. No jobs are run here."""
