"""Column-to-Column functions. Nothing here touches a DataFrame."""
