"""Plans that run scripts over tables, and steps that cut lineage."""
