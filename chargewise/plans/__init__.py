"""The jobs: rules 702, 706 and 710, the combine job and the run log."""
