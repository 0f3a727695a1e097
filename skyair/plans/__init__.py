"""Plans: marts and the flow from bronze files to mart tables."""
