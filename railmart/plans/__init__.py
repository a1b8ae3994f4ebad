"""Named queries over the star: marts, reports, measures and exports."""
