"""The jobs: which products are made from which lines, and where they go."""
