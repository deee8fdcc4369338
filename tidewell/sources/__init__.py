"""Where rows come from and go to: JSON feeds, merged tables, versioned tables, the demonstration feeds."""
