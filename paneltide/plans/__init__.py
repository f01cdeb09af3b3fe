"""Plans: wiring of operators into the reference's models, views and jobs."""
