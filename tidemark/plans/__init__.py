"""The five jobs: each module turns one data set into its cleaned table and its result tables."""
