"""Jobs: raw pages to silver, silver to gold, health, dashboard figures."""
