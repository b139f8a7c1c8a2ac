"""Reading the input tables and writing the intermediate and final ones."""
