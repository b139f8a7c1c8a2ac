"""Code sets, category maps and model coefficients."""
