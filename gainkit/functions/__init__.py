from gainkit.functions.measures import xlog2x, entropy_of_counts, plogp, safe_ratio, rounded
from gainkit.functions.curve import minmax_scale, inverse_minmax, even_grid, network_score, squared_loss
