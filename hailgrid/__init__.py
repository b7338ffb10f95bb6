"""hailgrid: trip cleaning, zone-hour demand, revenue facts and demand forecasts on PySpark."""
